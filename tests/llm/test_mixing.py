import hashlib
import random
from fractions import Fraction

from viewstar.llm.mixing import DOMAIN_WEIGHTS, LANG_WEIGHTS, mixed, selection


def share_out(budget, children):
    """Rounds of sharing by weight among the children that aren't full yet; children: name -> (cap, weight)."""
    got, left, rest = {}, dict(children), budget
    while left:
        total = sum(w for _, w in left.values())
        full = {k for k, (c, w) in left.items() if Fraction(c) <= Fraction(rest * w, total)}
        if not full:
            return got | {k: rest * w // total for k, (_, w) in left.items()}
        for k in full:
            got[k] = left[k][0]
        rest -= sum(left.pop(k)[0] for k in full)
    return got


def plain(rows, seed=11, percent=60, epochs=2):
    docs = []
    for i, t, lang, source in rows:
        digits = ""
        while (source or "") and len(digits) < len(source) and source[-1 - len(digits)].isdigit():
            digits = source[-1 - len(digits)] + digits
        docs.append((i, "other" if not digits else f"d{int(digits) % 4}", lang or "", source or "", len((t or "").split())))
    leaf = {}
    for _, d, g, s, n in docs:
        leaf[d, g, s] = leaf.get((d, g, s), 0) + n
    caps = {k: n * epochs for k, n in leaf.items()}
    budgets = {}
    top = share_out(sum(leaf.values()) * percent // 100, {d: (sum(c for k, c in caps.items() if k[0] == d), DOMAIN_WEIGHTS.get(d, 1)) for d in {k[0] for k in leaf}})
    for d, b in top.items():
        mid = share_out(b, {g: (sum(c for k, c in caps.items() if k[:2] == (d, g)), LANG_WEIGHTS.get(g, 1)) for g in {k[1] for k in leaf if k[0] == d}})
        for g, b2 in mid.items():
            low = share_out(b2, {s: (caps[d, g, s], 1) for s in {k[2] for k in leaf if k[:2] == (d, g)}})
            budgets |= {(d, g, s): x for s, x in low.items()}
    out = {}
    for k, b in budgets.items():
        mine = [(i, n) for i, d, g, s, n in docs if (d, g, s) == k]
        whole, rest = (b // leaf[k], b % leaf[k]) if leaf[k] else (0, 0)
        mine.sort(key=lambda x: (int(hashlib.md5(f"{seed}:{whole + 1}:{'' if x[0] is None else x[0]}".encode()).hexdigest()[:15], 16), x[0] is not None, x[0] or 0, x[1]))
        run = 0
        for i, n in mine:
            run += n
            copies = whole + (run <= rest)
            if copies:
                out.setdefault((i, *k, n), []).append(copies)
    return {k: sorted(v) for k, v in out.items()}


def some_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["src0"] * 6 + ["src1", "src2", "src3", "web", "src17", None])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 5, 50])), rng.choice(["en"] * 4 + ["de", "xx", None]), source))
    return rows


def test_equals_plain_budgeting(spark, docs_of):
    for seed in (1, 2):
        rows = some_rows(seed, 300)
        got = {}
        for r in selection(docs_of(rows)).collect():
            got.setdefault((r.doc_id, r.domain, r.lang, r.source, r.n_tokens), []).append(r.copies)
        assert {k: sorted(v) for k, v in got.items()} == plain(rows)


def test_shortage_goes_to_siblings_first(spark, docs_of):
    # domain d1: es is short, so de takes what es lacks and domain d0 gets no more than its share
    rows = [(i, "w " * 100, "de", "src1") for i in range(50)] + [(100, "w " * 10, "es", "src1")] + [(200 + i, "w " * 100, "en", "src0") for i in range(200)]
    got = selection(docs_of(rows), fraction_percent=20, max_epochs=1).collect()
    used = {}
    for r in got:
        used[r.domain, r.lang] = used.get((r.domain, r.lang), 0) + r.n_tokens * r.copies
    total = 25010 * 20 // 100
    assert used["d1", "es"] == 10 and abs(used["d1", "de"] - (total * 3 // 7 - 10)) <= 100 and abs(used["d0", "en"] - total * 4 // 7) <= 100


def test_edges(spark, docs_of):
    assert selection(docs_of([])).collect() == [] and mixed(docs_of([])).collect() == []
    empty = docs_of([(1, None), (2, ""), (None, None)])
    assert selection(empty).where("copies <> 0").count() in (0, 3)
    rows = [(7, "a b c"), (7, "a b c"), (None, "d e"), (8, "f " * 500)]
    out = mixed(docs_of(rows), fraction_percent=100, max_epochs=1)
    assert out.columns == docs_of([]).columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == sorted((i or 0, t) for i, t in rows)
    twice = mixed(docs_of(rows), fraction_percent=200, max_epochs=2)
    assert twice.count() == 8
