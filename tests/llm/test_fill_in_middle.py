import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from viewstar.llm import fill_in_middle as M

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    """The contract, unit by unit."""
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    if h4 % 100 < 80:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=300))
def test_ranks(seq):
    w = M.WaveletMatrix(np.array(seq, np.uint8), 3)
    at = np.arange(len(seq) + 1)
    for c in range(8):
        assert w.rank(c, at).tolist() == [seq[:i].count(c) for i in at]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab1é你 \t\n.<\U0001F600 ", max_size=40), min_size=1, max_size=6))
def test_every_cut(texts):
    units = M.Units(pa.array(texts))
    found = [UNIT.findall(t) for t in texts]
    assert units.n.tolist() == [len(u) for u in found]
    for k in range(max(map(len, found)) + 1):
        ks = np.minimum(k, units.n)
        ends = (units.ends(ks) - units.at[:-1]).tolist()
        assert ends == [len("".join(u[:j])) for u, j in zip(found, ks.tolist())]
        assert (units.byte(units.ends(ks)) - units.off[:-1]).tolist() == [len("".join(u[:j]).encode()) for u, j in zip(found, ks.tolist())]


TEXTS = [None, "", " ", "one", " lead", "trail \n", "a b c d e f g", "é 你好 \U0001F600 x", "has <P> inside", "has <S>", "<M>", "<P", "a< S> <<P <", "tab\tand\nline\r\n\n end\v\f", "  nbsp em", "x" * 5000,
         "word " * 20_000, "<", "<S", "é" * 70 + " " + "ß" * 70]


def test_against_plain_version(spark, docs_of):
    rows = [(i * 37 - 200, t) for i, t in enumerate(TEXTS * 20)] + [(None, "null id here and there"), (5, "same id"), (5, "same id")]
    got = M.fill_in_middle(docs_of(rows)).withColumn("back", M.restored(M.F.col("output"), M.F.col("form"))).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:5] is None, str(r))
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted([(i, *plain(i, t)) for i, t in rows], key=key)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_rates(spark, docs_of):
    assert M.fill_in_middle(docs_of([])).collect() == []
    rows = [(i, "a b c") for i in range(200)]
    assert {r.form for r in M.fill_in_middle(docs_of(rows), percent=0).collect()} == {"plain"}
    assert {r.form for r in M.fill_in_middle(docs_of(rows), percent=100, spm_percent=0).collect()} == {"psm"}


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_parts_that_look_like_markers(spark, form):
    pre, mid, suf = "a<", "S>b", "<M"
    out = f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}"
    assert spark.createDataFrame([(out, form)], "o string, f string").select(M.restored(M.F.col("o"), M.F.col("f"))).first()[0] == pre + mid + suf
