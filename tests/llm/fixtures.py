"""Small tables with every awkward case, and plain Python rules shared by the tests."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, rep long, component string, a int, b int, n long, words string, lines string, of string, key long, first string, draw int")


def words(text, low=True):
    return WORD.findall((text or "").translate(LOWER) if low else (text or ""))


def sample(spark, n=120):
    """Documents of the smallest test table."""
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(f"doc_id < {n}").collect()]


def awkward():
    """Null and empty texts, blanks, ties, copies, odd characters, very long texts, null labels."""
    story = "It was the best of times it was the worst of times it was the age of wisdom it was the age of foolishness it was the epoch of belief"
    long = " ".join(f"word{i * 7919 % 1000}" for i in range(30_000))
    return [(1000, None, "en"), (1001, "", "en"), (1002, " \n\t ", "de"), (1003, story, "en"), (1004, story, None), (1005, story.upper(), "en"), (1006, "one", "en"),
            (1007, "one", "fr"), (1008, "naïve 😀 漢字 ﬁ\x00 tab\tend\n\nlast", "fr"), (1009, long, "en"), (1010, long + " tail", "en"), (1011, "a" * 5000, None),
            (1012, "12345 67890 !!! ???", "en"), (1013, story + "\n" + story + "\nnew line of other words here now", "en"), (1014, "\n", "en"), (1015, "two words", "es")]


def frame(spark, rows):
    """A documents table with extra columns whose names clash with those the operators use inside."""
    return spark.createDataFrame([(i, t, g, "src", len(t or ""), 5, "x", 1, 2, 3, "w", "l", "o", 9, "f", 4) for i, t, g in rows], SCHEMA)


def repeated(rows):
    """Rows without id and rows that repeat an id; the smallest text of an id counts."""
    return [*rows, (None, "no id at all", "en"), (None, None, None), (rows[0][0], rows[0][1], rows[0][2]), (rows[1][0], "~ a larger text", "en")]
