import math
import re
from collections import Counter

import numpy as np
import pytest

from viewstar.llm import fertility as Fe

public_tokenizers = pytest.importorskip("public_tokenizers")
PATHS = [public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken")]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def encoders():
    out = []
    for path, kind in zip(PATHS, (Fe.Pieces, Fe.Merges)):
        with open(path, "rb") as f:
            out.append(kind(f.read()))
    return out


def plain_base(text):
    text = text or ""
    w = WORD.findall(text)
    lines, seen, dup = [x for x in text.split("\n") if WORD.search(x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    count = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if count[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def plain_measures(text, encode):
    w = WORD.findall(text or "")
    ids = [i for x in w for i in encode([x])[0]]
    if not ids:
        return None
    n, count = len(ids), Counter(ids)
    return sum(map(len, w)) / n, sum(bool(encode.is_byte[i]) for i in ids) / n, -sum(c / n * math.log2(c / n) for c in count.values())


TEXTS = [None, "", " \n\t", "one", "a b c a b c", "a b c\na b c\n a b c\nd\n\nd\nd ", "THE the The\r\nthe\r\n", "# * $%& |<> ##", "x" * 9000 + " " + "x" * 9000,
         "é ü 你好 мир ελ \U0001F600\U0001F601 ﷽", "line " * 3000, "same long line " * 400 + "\n" + "same long line " * 400, "\x0b\x0c a\x0bb", "Ab aB ab Ab aB ab", "a b c d"]


def test_counts_and_measures_against_plain_version(spark, docs_of):
    rows = [(i, t, None if i % 5 == 0 else "en") for i, t in enumerate(TEXTS * 2)] + [(None, "no id"), (3, "again")]
    got = Fe.judged(docs_of(rows), PATHS).collect()
    assert len(got) == len(rows)
    want = {}
    for r in rows:
        want.setdefault((r[0], plain_base(r[1])), r)
    for r in got:
        base = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        row = want[r.doc_id, base]
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0]) and r.kept == (not r.base_failed)
        for v, e in enumerate(encoders()):
            m = plain_measures(row[1], e)
            have = (r[f"chars_per_token_{v}"], r[f"byte_share_{v}"], r[f"entropy_{v}"])
            assert have == (None, None, None) if m is None else np.allclose(have, m, atol=1e-9)


def sentences(rng, n, words):
    return " ".join(rng.choice(words, n))


def plain_bands(values, width, least, down, up):
    bins = sorted(math.floor(v / width) for v in values)
    q1, q3 = (bins[math.ceil(len(bins) * k / 4) - 1] for k in (1, 3))
    reach = max((q3 - q1) * width, least)
    return None if down is None else q1 * width - reach * down, None if up is None else (q3 + 1) * width + reach * up


def test_bands_and_verdicts(spark, docs_of):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("aeiourstlnm"), rng.integers(2, 9))) for _ in range(3000)]
    rows = [(i, sentences(rng, int(rng.integers(60, 400)), words), "en") for i in range(400)]
    rows += [(1000, " ".join(w.upper() + "!?%" for w in rng.choice(words, 200)), "en"), (1001, sentences(rng, 300, words[:6]), "en"),
             (1002, " ".join("".join(map(chr, rng.integers(0x1F300, 0x1F5FF, 3))) for _ in range(80)) + " abc", "en"), (1003, sentences(rng, 20, words), "en")]
    rows += [(2000 + i, " ".join(w.upper() + "!?%" for w in rng.choice(words, 100)), "rare") for i in range(5)]
    got = {r.doc_id: r for r in Fe.judged(docs_of(rows), PATHS).collect()}
    assert all(got[i].kept for i in range(400)) and all(got[2000 + i].kept for i in range(5))
    assert not any(got[i].kept for i in (1000, 1001, 1002, 1003))
    assert "chars_per_token:1" in got[1000].against and "entropy:0" in got[1001].against and "byte_share:0" in got[1002].against
    # the same verdicts from plain quartiles
    sound = [r for r in got.values() if not r.base_failed and r.language_script == "en/latin"]
    for v in range(2):
        for name, rule in Fe.FENCES.items():
            low, high = plain_bands([r[f"{name}_{v}"] for r in sound], *rule)
            for r in got.values():
                if r.language_script == "en/latin":
                    x = r[f"{name}_{v}"]
                    assert (f"{name}:{v}" in r.against.split(",")) == ((low is not None and x < low) or (high is not None and x > high))


def test_scripts():
    import pyarrow as pa
    texts = ["", "12 !", "abc", "été", "Ελλάδα", "мир", "שלום", "مرحبا", "हिन्दी", "ひらがな", "漢字", "한글", "abc мир мир", None]
    buf, off = Fe.text_bytes(pa.array(texts), lower=False)
    assert Fe.scripts(buf, off) == ["none", "none", "latin", "latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "kana", "han", "hangul", "cyrillic", "none"]


def test_empty_table(spark, docs_of):
    assert Fe.judged(docs_of([]), PATHS).collect() == []
