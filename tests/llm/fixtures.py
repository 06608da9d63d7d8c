"""Small tables with the awkward cases every corpus operator must handle."""

import random

WORDS = "alder birch cedar dogwood elm fir ginkgo hazel ivy juniper kapok larch maple oak".split()
# Columns whose names clash with ones the operators use inside.
EXTRA = "score double, fp long, n long, h long, id string, kid long, words int"


def prose(seed, n, vocabulary=WORDS):
    rng = random.Random(seed)
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "s", "y", "ing"]) for _ in range(n))


def lines(seed, n, words=8):
    return "\n".join(prose(f"{seed}-{k}", words) for k in range(n))


def document_rows():
    """(doc_id, text, lang, source, n_chars), with nulls, blanks, copies and a long text."""
    texts = [lines(k, 4 + k % 5) for k in range(24)]
    texts += [texts[3], texts[3], texts[5] + "\n" + texts[6], None, "", " \t\n ", "one", "one two"]
    texts += ["word " * 4000, lines("long", 400)]
    rows = [(k, t, "en", f"s{k % 3}" if k % 7 else None, len(t or "")) for k, t in enumerate(texts)]
    rows += [rows[4], (None, texts[8], None, None, None), (None, None, None, None, None)]
    return rows


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=None, extra=True):
    rows = document_rows() if rows is None else rows
    if not extra:
        return spark.createDataFrame(rows, DOCUMENTS)
    clash = (0.5, 7, 8, 9, "x", 10, 11)
    return spark.createDataFrame([(*r, *clash) for r in rows], f"{DOCUMENTS}, {EXTRA}")
