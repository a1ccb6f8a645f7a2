import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from llm_cases import documents, sentence
from tokenizers import Tokenizer

from gridcast.llm import alignment, queries
from gridcast.llm.packing import byte_values


def plain(texts):
    """Figures of each text, token by token."""
    a_coder, value = Tokenizer.from_file(queries.TOKENIZER), byte_values()
    a_coder.encode_special_tokens = True
    b_coder = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    docs, counts = [], Counter()
    for text in texts:
        a = a_coder.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_coder.encode(text) if text else []
        a_bytes = [bytes(value[c] for c in a_coder.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_coder.id_to_piece(i)[3:5], 16)]) if b_coder.is_byte(i) else
                   b_coder.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            docs.append(None)
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        at = dict(zip(b_ends, b))
        links = [(x, at[e]) for x, e in zip(a, a_ends) if e in at]
        groups, i, j = [], 0, 0
        for cut in sorted(set(a_ends) & set(b_ends)):
            m, n = a_ends.index(cut, i) + 1, b_ends.index(cut, j) + 1
            groups.append(",".join(map(str, a[i:m])) + "|" + ",".join(map(str, b[j:n])))
            i, j = m, n
        counts.update(links)
        docs.append((len(a), len(b), links, ";".join(groups)))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (d[0], d[1], len(d[2]), len(d[2]), sum(counts[p] == most[p[1]] for p in d[2]), sum(counts[p] for p in d[2]),
             hashlib.sha256(d[3].encode()).hexdigest()) for d in docs]


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [None, "", " ", "a", "  two  spaces ", "tab\tand\nline", "<|endoftext|> and </s> <0x41>", "▁ mark", "naïve 一二三 \U0001f642‍\U0001f680",
       "ﬁ ligature", "é combining", "x" * 5000, "\u0000 null byte", "Wortßen 12345 67.89 don't I'LL"]


@pytest.mark.parametrize("frequent, held", [(alignment.FREQUENT, alignment.HELD), (7, 10), (0, 1)])
def test_figures_equal_the_plain_version(spark, frequent, held):
    rng = random.Random(2)
    texts = ODD + [sentence(rng, rng.randrange(1, 200), 90) for _ in range(30)] + ["same text twice"] * 3
    docs = documents(spark, [(i, t) for i, t in enumerate(texts)], clashing=True).repartition(3)
    got = alignment.aligned(docs, queries.TOKENIZER, queries.PIECES, frequent=frequent, held=held).toPandas().set_index("id")
    want = plain(texts)
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert tuple(got.loc[i, FIGURES]) == w, texts[i]


def test_rows_without_ids_and_repeated_rows(spark):
    texts = ["to be or not", "to be or not", "that is", None]
    got = alignment.aligned(documents(spark, [(None, texts[0]), (None, texts[1]), (5, texts[2]), (None, None)]), queries.TOKENIZER, queries.PIECES)
    assert sorted(tuple(r[f] for f in FIGURES) for r in got.collect()) == sorted(plain(texts))


def test_empty_table(spark):
    assert alignment.aligned(documents(spark, []), queries.TOKENIZER, queries.PIECES).collect() == []


def test_labels_are_the_components_under_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        cut = lambda: np.append(np.flatnonzero(rng.random(n) < rng.random()) + 1, n)
        a, b = np.unique(cut()), np.unique(cut())
        of_a, of_b = alignment.labels(a, b)
        common = np.intersect1d(a, b)
        assert (np.searchsorted(common, a) == np.searchsorted(common, b[of_a])).all()
        assert (np.searchsorted(common, b) == np.searchsorted(common, b[of_b])).all() and set(b[of_b]) == set(common)
