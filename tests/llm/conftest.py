import re

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, id string"


def words_of(text):
    """Blank-separated words, lower-cased in A-Z."""
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles_of(text, size=5):
    w = words_of(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with columns of clashing names from (doc_id, text[, lang, source]) rows."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src1", None if r[1] is None else len(r[1]), "x", None) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make
