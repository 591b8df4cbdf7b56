"""Rows that every operator must survive: nulls, empty and long texts, repeated
rows, ties, ids that repeat, and columns whose names clash with inner ones."""

WORDS = "the of and river stone under open wind field light green house over small road".split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 17
    for i in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x >> 8 & 15 if (x >> 8 & 15) < len(WORDS) else 0] + (str(x % 97) if x % 5 == 0 else ""))
    return " ".join(out)


LONG = prose(99, 30_000)
BASE = prose(1, 120)
NEAR = BASE + " tail"

ROWS = [
    (1, BASE, "en", "a"),
    (2, BASE, "en", "a"),
    (2, BASE, "en", "a"),  # a repeated row
    (3, NEAR, None, None),
    (4, None, "fr", "b"),
    (5, "", "fr", "b"),
    (6, " \n\t ", "de", "c"),
    (7, "Short one", None, None),
    (8, "short ONE", "en", "a"),
    (None, prose(5, 60), "en", "b"),
    (None, None, None, None),
    (9, LONG, "de", "c"),
    (10, "été über ßtraße \U0001f600 日本語 é K İ", "fr", "z"),
    (10, "the same id again", "en", "a"),
    (11, "123 !!! --- 456", "en", "a"),
]
#: Names that operators use inside.
CLASH = ["component_id", "n_shingles", "group", "hash", "c", "n", "raw", "h", "size", "target", "taken", "bucket", "words",
         "labels", "score", "lang_pred", "held_out", "klass", "worker", "ids", "start", "r", "closing", "uid", "text_hash", "_pii", "pii_count"]


def frame(spark, rows=None, clash=True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ROWS if rows is None else rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({k: F.lit(f"x{i}") for i, k in enumerate(CLASH)}) if clash else df


def tuples(df, *cols):
    key = lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r)
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=key)
