"""Documents that try the operators' defined cases."""

from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = DOCUMENTS + ", kept boolean, keep_id long, `text_sha256` string, id long, row string, node string, `odd name` string"


def documents(spark, rows, clashing=False):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
    if not clashing:
        return spark.createDataFrame(full, DOCUMENTS)
    return spark.createDataFrame([(*r, True, 7, "x", 1, "y", "z", "o") for r in full], T._parse_datatype_string(CLASHING))


def sentence(rng, n, words=3000):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edited(rng, text, share):
    out = []
    for word in text.split():
        x = rng.random()
        if x < share / 3:
            continue
        out.append(word if x > share else f"e{rng.randrange(10**6)}" if x < 2 * share / 3 else f"{word} e{rng.randrange(10**6)}")
    return " ".join(out)
