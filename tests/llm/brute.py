"""Plain Python versions and odd tables for the tests of the corpus operators."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def table(spark, rows, extra=()):
    """rows: (doc_id, text, source); extra columns have names that operators use inside."""
    full = [(i, t, "en", s, None, *["clash"] * len(extra)) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA + "".join(f", `{c}` string" for c in extra))


CLASHES = ("id", "key", "size", "row", "word", "words", "line", "w", "n", "host", "kept", "source_size", "media", "ids", "at", "rank")


def odd_rows(seed=3, n=60, vocabulary=40, lines=True):
    """Nulls, empty and long texts, ties, repeated rows and passages that texts share."""
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(vocabulary)] + ["the", "licensed", "under", "é", "ß", "日本", "#tag", "a&b"]
    text = lambda k: "".join(rnd.choice(vocab) + (rnd.choice(["\n", ".\n", " ", " ", " ", "\t", "  "]) if lines else " ") for _ in range(k))
    passages = [text(30) for _ in range(3)]
    rows = [(None, None, None), (900, None, "b"), (901, "", "b"), (902, "   \n ", None), (None, text(40), "a"), (903, text(6000), "a"), (904, "x" * 50000, "a"), (905, "\n".join(["again and again"] * 500), "c")]
    for i in range(n):
        t = text(rnd.randint(1, 80))
        if rnd.random() < 0.5:
            t = t + passages[rnd.randrange(3)] + text(rnd.randint(0, 10))
        rows.append((i, t, rnd.choice(["a", "a", "b", "c", "", None])))
    rows += [rows[10], rows[10], (1000, rows[12][1], "a"), (1001, rows[12][1], "b"), (1002, rows[903 - 898][1], "a")]
    return rows
