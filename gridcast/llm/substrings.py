"""Substring dedup: passages that repeat across documents, found by collinear chaining.

1. Seeds. Of every window of `window` successive k-mers of words the one with the smallest hash is a seed
   (minimizers), so two documents that share k + window - 1 words in a row share a seed there.
2. Join. Of each seed that occurs in several documents the smallest document id is the holder, and likewise of
   each run of RUNS successive such seeds, as a run's holder shares more of the passage than a seed's. A document
   is paired with the holders of two of its seeds or of a run, never with all documents that share them: a passage in a
   third of all documents makes a few pairs per document.
3. Chains. For a pair all shared seeds are matched, also those held by third documents. Matches are chained in
   the order of both texts under a cost per skipped word of either text. A Fenwick tree over the places in the holder
   gives the best predecessor among the matches at most MAX_GAP words back in both texts: matches enter as the sweep
   over the document passes them and leave when they are out of reach, so a long chain hides none behind it.
4. Alignment. A chain is aligned word by word: gaps between its seeds by longest common subsequences, both ends
   outwards while they agree within a few edits. The longest stretch of at least `min_words` words and `identity`
   agreement is a passage of the document that an earlier document holds; so is what is left of the chain on either
   side of it, if it is as long and as equal.

The smallest id keeps its copy of a passage; in the others it can be cut.

Defined cases. Null, empty or short texts, null ids: no spans. Repeated rows: the rows of an id count as one
document, no row is a repeat of another row of its id; spans are aligned with each of its texts. Empty table:
empty result. Words are runs of bytes outside ASCII white space, A-Z as a-z. `without_repeats` keeps the
columns of the input, whatever their names, cuts the spans from the text, and drops documents of which no word
is left (documents without words stay).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gridcast.llm import words as w
from gridcast.llm.tables import passing, stage

K = 5
WINDOW = 12
RUNS = (3, 6)
MIN_WORDS = 50
IDENTITY = 0.8
#: Words of either text between two seeds of a chain, and beyond its ends, at most.
MAX_GAP = 40
#: Words that a passage may go on beyond its outermost seeds without another one.
REACH = 24
#: Beyond the ends of a chain: edits in a row, and equal words after them (one more if the edits shift the texts).
EDITS, AGREE = 8, 2
#: Cost of a skipped word, against 1 for a word of a matched seed: a step over MAX_GAP words of both texts costs less than a seed is worth.
GAP_COST = 0.06
PART_BYTES = 1 << 20
CHAINS_AT_ONCE = 64

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# ---- seeds

def _minimizers(kmers: np.ndarray, window: int) -> np.ndarray:
    if len(kmers) <= window:
        return np.array([int(kmers.argmin())])
    least = np.lib.stride_tricks.sliding_window_view(kmers, window).argmin(1) + np.arange(len(kmers) - window + 1)
    return least[np.flatnonzero(np.diff(least, prepend=-1))]


def _seeds(k: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows, at, found = b.column(0), [], [], []
            data, offsets = w.buffers(b.column(1))
            for low, high in w.slices(offsets, PART_BYTES):
                part = data[offsets[low]:offsets[high]]
                starts, ends, first = w.word_spans(part, offsets[low:high + 1] - offsets[low])
                kmers = w.runs(w.word_hashes(part, starts, ends), k)
                for row, (x, y) in enumerate(zip(first[:-1], first[1:]), low):
                    if y - x >= k:
                        own = kmers[x:y - k + 1]
                        chosen = _minimizers(own, window)
                        rows.append(np.full(len(chosen), row))
                        at.append(chosen)
                        found.append(own[chosen])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), ids.take(pa.array(np.concatenate(rows))),
                     pa.array(np.concatenate(at).astype(np.int32))], names=["seed", "doc", "at"])

    return w.lean(run)


# ---- chains

class _Maxima:
    """A Fenwick tree of (worth, match) over ranks 1..n: maxima over any range of ranks; entries come and go."""

    NONE = (-1e18, -1)

    def __init__(self, n: int) -> None:
        self.n, self.own, self.tree = n, [self.NONE] * (n + 1), [self.NONE] * (n + 1)

    def enter(self, rank: int, entry: tuple[float, int]) -> None:
        self.own[rank] = entry
        while rank <= self.n and self.tree[rank] < entry:
            self.tree[rank] = entry
            rank += rank & -rank

    def leave(self, rank: int) -> None:
        gone, self.own[rank] = self.own[rank], self.NONE
        while rank <= self.n and self.tree[rank] == gone:
            best, step = self.own[rank], 1
            while step < rank & -rank:
                best = max(best, self.tree[rank - step])
                step <<= 1
            self.tree[rank] = best
            rank += rank & -rank

    def best(self, low: int, high: int) -> tuple[float, int]:
        out = self.NONE
        while high >= low:
            under = high - (high & -high)
            if under + 1 >= low:
                out, high = max(out, self.tree[high]), under
            else:
                out, high = max(out, self.own[high]), high - 1
        return out


def best_chains(x: list[int], y: list[int], k: int, gap_cost: float, max_gap: int) -> list[list[int]]:
    """Chains of matches (x[i], y[i]), x ascending: index lists with x and y ascending, best chain first.

    A chain is worth k for each match, less gap_cost for each word that a step goes on in x or y beyond k.
    The step cost is a difference of x + y, so the best predecessor of a match is the maximum of
    value + gap_cost * (x + y) over the matches before it that lie within reach in both texts: a range of ranks of y
    in a Fenwick tree that holds the matches within reach in x.
    """
    n, reach = len(x), max_gap + k
    order = sorted(range(n), key=y.__getitem__)
    places, rank = [y[i] for i in order], [0] * n
    for r, i in enumerate(order, 1):
        rank[i] = r
    maxima = _Maxima(n)
    value, before = [float(k)] * n, [-1] * n
    entered = left = 0
    for j in range(n):
        while x[entered] < x[j]:
            maxima.enter(rank[entered], (value[entered] + gap_cost * (x[entered] + y[entered]), entered))
            entered += 1
        while x[j] - x[left] > reach:
            maxima.leave(rank[left])
            left += 1
        worth, at = maxima.best(bisect_left(places, y[j] - reach) + 1, bisect_left(places, y[j]))
        gain = worth - gap_cost * (x[j] + y[j] - 2 * k)
        if at >= 0 and gain > 0:
            value[j], before[j] = k + gain, at
    used, out = [False] * n, []
    for m in sorted(range(n), key=lambda m: -value[m]):
        chain = []
        while m >= 0 and not used[m]:
            used[m] = True
            chain.append(m)
            m = before[m]
        if chain:
            out.append(chain[::-1])
    return out


def _lists(column: pa.Array) -> list[list]:
    """The rows of a list column."""
    at = column.offsets.to_numpy() - column.offsets[0].as_py()
    flat = column.flatten().to_numpy().tolist()
    return [flat[x:y] for x, y in zip(at[:-1], at[1:])]


def _chain(k: int, reach: int, min_words: int, gap_cost: float, max_gap: int):
    """From (doc, holder, places and seeds of both, in the order of the text): a row per chain of two seeds or
    more that can reach min_words. reach: words that a passage can go on beyond its outermost seeds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, places = None, {}
        for b in batches:
            rows, chains = [], []
            holders = b.column(1).to_pylist()
            at, seeds, their_at, theirs = (_lists(b.column(i)) for i in range(2, 6))
            for r, holder in enumerate(holders):
                if holder != last:
                    last, places = holder, {}
                    for seed, place in zip(theirs[r], their_at[r]):
                        places.setdefault(seed, []).append(place)
                # A seed that repeats is matched in step with the holder's repeats: one match for each place.
                x, y, met = [], [], Counter()
                for place, seed in zip(at[r], seeds[r]):
                    if own := places.get(seed):
                        x.append(place)
                        y.append(own[met[seed] % len(own)])
                        met[seed] += 1
                for chain in best_chains(x, y, k, gap_cost, max_gap):
                    if len(chain) > 1 and x[chain[-1]] + k - x[chain[0]] + 2 * reach >= min_words:
                        rows.append(r)
                        chains.append(([x[i] for i in chain], [y[i] for i in chain]))
            if rows:
                some = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(some), b.column(1).take(some), pa.array([c[0] for c in chains], pa.list_(pa.int32())),
                     pa.array([c[1] for c in chains], pa.list_(pa.int32()))], names=["doc", "holder", "x", "y"])

    return w.lean(run)


# ---- alignment

def _split(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def _windows(k: int, margin: int):
    """From (doc, its chains, its text): each chain with the words of the text around it, and the number of the first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, out = [], []
            for r, (chains, text) in enumerate(zip(b.column(1), b.column(2))):
                words = _split(text.as_py())
                for c in chains.as_py():
                    begin = max(0, c["x"][0] - margin)
                    rows.append(r)
                    out.append((c["holder"], c["part"], c["x"], c["y"], b" ".join(words[begin:c["x"][-1] + k + margin]), begin))
            if rows:
                holder, part, x, y, parts, begins = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows, pa.int32())), pa.array(holder, b.column(0).type), pa.array(part, pa.int64()),
                     pa.array(x, pa.list_(pa.int32())), pa.array(y, pa.list_(pa.int32())), pa.array(parts, pa.binary()), pa.array(begins, pa.int32())],
                    names=["doc", "holder", "part", "x", "y", "words", "begin"])

    return w.lean(run)


Pairs = list[tuple[int, int]]


def _lcs(a: list[bytes], b: list[bytes]) -> Pairs:
    """Places of a longest common subsequence."""
    low, high = 0, min(len(a), len(b))
    while low < high and a[low] == b[low]:
        low += 1
    tail = 0
    while tail < high - low and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    out = [(i, i) for i in range(low)]
    mid_a, mid_b = a[low:len(a) - tail], b[low:len(b) - tail]
    if mid_a and mid_b:
        rows = [[0] * (len(mid_b) + 1)]
        for u in mid_a:
            last, row = rows[-1], [0]
            for j, v in enumerate(mid_b):
                row.append(last[j] + 1 if u == v else max(row[j], last[j + 1]))
            rows.append(row)
        i, j, back = len(mid_a), len(mid_b), []
        while i and j:
            if mid_a[i - 1] == mid_b[j - 1]:
                i, j = i - 1, j - 1
                back.append((low + i, low + j))
            elif rows[i - 1][j] >= rows[i][j - 1]:
                i -= 1
            else:
                j -= 1
        out += back[::-1]
    return out + [(len(a) - t, len(b) - t) for t in range(tail, 0, -1)]


def _common(a: list[bytes], b: list[bytes]) -> int:
    """Words in the longest common subsequence."""
    return len(_lcs(a, b))


def _agree(a: list[bytes], b: list[bytes], words: int) -> bool:
    return len(a) >= words and a[:words] == b[:words]


def _outwards(a: list[bytes], b: list[bytes], edits: int = EDITS, agree: int = AGREE) -> Pairs:
    """Equal words as far as a and b go on together: past some edits a few words must agree again."""
    i = j = 0
    out = []
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
            continue
        u, v = next(((u, skip - u) for skip in range(1, edits + 1) for u in range(skip + 1)
                     if _agree(a[i + u:i + u + agree + 1], b[j + skip - u:j + skip - u + agree + 1], agree + (2 * u != skip))), (0, 0))
        if not u + v:
            break
        i, j = i + u, j + v
    return out


def matched(a: list[bytes], b: list[bytes], x: list[int], y: list[int], k: int) -> Pairs | None:
    """Places of the equal words along a chain of equal k-mers (x, y), ascending in both; None if a k-mer is not equal."""
    if a[x[0]:x[0] + k] != b[y[0]:y[0] + k] or len(a[x[0]:x[0] + k]) < k:
        return None
    out = [(x[0] + t, y[0] + t) for t in range(k)]
    i, j = x[0] + k, y[0] + k
    for u, v in zip(x[1:], y[1:]):
        if a[u:u + k] != b[v:v + k] or len(a[u:u + k]) < k:
            return None
        inside = max(0, i - u, j - v)  # words of this k-mer that the last one has covered
        u2, v2 = u + inside, v + inside
        if inside < k:
            if i < u2 and j < v2:
                out += [(i + p, j + q) for p, q in _lcs(a[i:u2], b[j:v2])]
            out += [(u + t, v + t) for t in range(inside, k)]
            i, j = u + k, v + k
    before = _outwards(a[:x[0]][::-1], b[:y[0]][::-1])
    return ([(x[0] - 1 - p, y[0] - 1 - q) for p, q in reversed(before)] + out
            + [(i + p, j + q) for p, q in _outwards(a[i:], b[j:])])


def align(a: list[bytes], b: list[bytes], x: list[int], y: list[int], k: int) -> tuple[int, int, int, int, int] | None:
    """Span of a, span of b and number of equal words along a chain of equal k-mers (x, y)."""
    pairs = matched(a, b, x, y, k)
    return pairs and _span(pairs)


def _span(pairs: Pairs) -> tuple[int, int, int, int, int]:
    return pairs[0][0], pairs[-1][0] + 1, pairs[0][1], pairs[-1][1] + 1, len(pairs)


def passages(pairs: Pairs, min_words: int, identity: float) -> Iterator[tuple[int, int, int, int, int]]:
    """The longest stretch of equal words that spans min_words words and of which the share `identity` is equal, and
    likewise in what is left before and behind it."""
    rest = [pairs]
    while rest:
        some = rest.pop()
        if len(some) < identity * min_words or some[-1][0] + 1 - some[0][0] < min_words:
            continue
        x0, x1, y0, y1, same = _span(some)
        if same >= identity * max(x1 - x0, y1 - y0):
            yield x0, x1, y0, y1, same
            continue
        at = np.array(some)
        # A stretch from p to q is equal enough if score[q] >= score[p] - (1 - identity): every word counts, the
        # skipped ones of the text that skips more.
        steps = 1 - identity * np.diff(at, axis=0).max(1)
        score = np.concatenate([[0.0], np.cumsum(steps)])
        lowest = np.minimum.accumulate(score)
        first = np.searchsorted(-lowest, -(score + (1 - identity) + 1e-9))
        length = at[:, 0] - at[first, 0]
        q = int(length.argmax())
        p = int(first[q])
        x0, x1, y0, y1, same = _span(some[p:q + 1])
        if x1 - x0 < min_words:
            continue
        if same >= identity * max(x1 - x0, y1 - y0):
            yield x0, x1, y0, y1, same
        rest += [some[:p], some[q + 1:]]


def _aligned(k: int, min_words: int, identity: float, margin: int):
    """From (holder, chains with the words of their documents, the holder's text): a row per passage."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for r, (chains, text) in enumerate(zip(b.column(1), b.column(2))):
                words = _split(text.as_py())
                for c in chains.as_py():
                    start = max(0, c["y"][0] - margin)
                    pairs = matched(c["words"].split(b" "), words[start:c["y"][-1] + k + margin],
                                    [v - c["begin"] for v in c["x"]], [v - start for v in c["y"]], k)
                    for x0, x1, y0, y1, same in passages(pairs or [], min_words, identity):
                        cells = (c["doc"], r, x0 + c["begin"], x1 + c["begin"], y0 + start, y1 + start, same)
                        for column, cell in zip(out, cells):
                            column.append(cell)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], b.column(0).type), b.column(0).take(pa.array(out[1], pa.int32())), *[pa.array(c, pa.int32()) for c in out[2:]]],
                    names=["doc", "holder", *SPAN])

    return w.lean(run)


SPAN = ["start_word", "end_word", "holder_start", "holder_end", "equal_words"]


def _run_keys(m: int):
    """A hash of every run of m successive seeds in the column `seeds`."""
    run = f"xxhash64({m}, slice(seeds, i, {m}))"
    return F.expr(f"transform(sequence(1, greatest(size(seeds) - {m - 1}, 1)), i -> IF(size(seeds) >= {m}, {run}, NULL))")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW,
            min_words: int = MIN_WORDS, identity: float = IDENTITY, gap_cost: float = GAP_COST, max_gap: int = MAX_GAP) -> DataFrame:
    """Columns doc, holder (ids; holder < doc) and the span of words [start, end) in each; equal_words of them agree."""
    plain = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")
    kind = plain.schema["doc"].dataType.simpleString()
    with passing(docs.sparkSession) as used:
        seeds = stage(plain.mapInArrow(_seeds(k, window), f"seed long, doc {kind}, at int"), "seeds")
        held = stage(seeds.groupBy("seed").agg(F.min("doc").alias("holder"), F.max("doc").alias("last"))
                     .where("holder < last").select("seed", "holder"), "held")
        shared = seeds.join(held.hint("merge"), "seed").groupBy("doc").agg(
            F.array_sort(F.collect_list(F.struct("at", "seed", "holder"))).alias("s")).select(
            "doc", F.col("s.at").alias("at"), F.col("s.seed").alias("seeds"), F.col("s.holder").alias("holders"))
        shared = stage(shared, "shared")
        # A shared stretch of min_words holds at least two seeds, so one seed of a holder makes no pair.
        runs = stage(shared.select("doc", F.explode(F.concat(*[_run_keys(m) for m in RUNS])).alias("run")).where("run IS NOT NULL"), "runs")
        held = stage(runs.groupBy("run").agg(F.min("doc").alias("holder"), F.max("doc").alias("last"))
                     .where("holder < last").select("run", "holder"), "held")
        partners = (runs.join(held.hint("merge"), "run").where("holder < doc").select("doc", "holder")
                    .unionAll(shared.select("doc", F.explode("holders").alias("holder")).where("holder < doc")
                              .groupBy("doc", "holder").count().where("count > 1").select("doc", "holder"))
                    .distinct())
        pairs = (stage(partners, "partners").join(shared.drop("holders").hint("merge"), "doc")
                 .join(shared.select(F.col("doc").alias("holder"), F.col("at").alias("their_at"), F.col("seeds").alias("theirs")).hint("merge"), "holder"))
        chains = stage(pairs.select("doc", "holder", "at", "seeds", "their_at", "theirs").mapInArrow(
            _chain(k, REACH, min_words, gap_cost, max_gap), f"doc {kind}, holder {kind}, x array<int>, y array<int>"), "chains")

        # Texts are joined to the chains of a document, and to parts of the chains of a holder: a text is never
        # repeated for each chain, and no row holds more than about CHAINS_AT_ONCE chains of a holder.
        parts = stage(chains.groupBy("holder").agg(F.ceil(F.count(F.lit(1)) / CHAINS_AT_ONCE).alias("parts")), "parts")
        used.keep(chains, parts)
    dealt = chains.join(parts.hint("merge"), "holder").select(
        "doc", F.struct("holder", F.pmod(F.xxhash64("doc"), "parts").alias("part"), "x", "y").alias("chain"))
    margin = REACH + MAX_GAP
    # Both joins read one shuffle of the texts by id.
    ours = dealt.groupBy("doc").agg(F.collect_list("chain").alias("chains")).join(plain.hint("merge"), "doc")
    ours = ours.select("doc", "chains", "text").mapInArrow(
        _windows(k, margin), f"doc {kind}, holder {kind}, part long, x array<int>, y array<int>, words binary, begin int")
    theirs = ours.groupBy("holder", "part").agg(F.collect_list(F.struct("doc", "x", "y", "words", "begin")).alias("chains"))
    theirs = theirs.join(plain.withColumnRenamed("doc", "holder").hint("merge"), "holder")
    return theirs.select("holder", "chains", "text").mapInArrow(
        _aligned(k, min_words, identity, margin), f"doc {kind}, holder {kind}, " + ", ".join(f"{c} int" for c in SPAN)).distinct()


# ---- cutting

def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, left = [], []
        for text, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if not spans:
                texts.append(text)
                left.append(True)
                continue
            raw = text.encode()
            at = [m.span() for m in _WORD.finditer(raw)]
            out, seen, words_left = [], 0, len(at)
            reached = 0
            for s in sorted(spans, key=lambda s: (s["start_word"], s["end_word"])):
                begin, end = max(reached, s["start_word"]), min(s["end_word"], len(at))
                if begin < end:
                    out.append(raw[seen:at[begin][0]])
                    seen = at[end][0] if end < len(at) else len(raw)
                    words_left -= end - begin
                    reached = end
            texts.append(b"".join([*out, raw[seen:]]).decode())
            left.append(words_left > 0)
        yield pa.RecordBatch.from_arrays([pa.array(texts, b.column(0).type), b.column(2)], names=["text", "row"]).filter(
            pa.array(left, pa.bool_()))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """The documents with repeated passages cut out, except where the smallest id holds them; `size_col`, if
    there is such a column, becomes the length of the new text."""
    with passing(docs.sparkSession) as used:
        spans = repeats(docs, id_col, text_col)
        spans = stage(spans.groupBy("doc").agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans")), "cuts")
        used.keep(spans)
    wide = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    joined = wide.join(spans.hint("merge"), "doc", "left").select("text", "spans", "row")
    schema = T.StructType([wide.schema["text"], wide.schema["row"]])
    cut = joined.mapInArrow(w.lean(_cut), schema)
    return cut.select(*[
        F.col("text").alias(c) if c == text_col
        else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == size_col
        else F.col("row").getField(c).alias(c) for c in docs.columns])
