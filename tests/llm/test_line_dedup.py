import hashlib
from collections import defaultdict

from sievekit.llm import line_dedup as L

WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line).strip(WS)


def brute(rows, min_docs, keep, min_chars=1):
    docs = defaultdict(set)
    where = defaultdict(list)
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in order:
        for p, line in enumerate((t or "").split("\n")):
            if len(key(line)) >= min_chars:
                docs[key(line)].add((i, t))
                where[key(line)].append((i, t, p))
    out = []
    for i, t in rows:
        kept = []
        for p, line in enumerate((t or "").split("\n")):
            k = key(line)
            hot = len(k) >= min_chars and len(docs[k]) >= min_docs
            if not hot or keep == "first" and where[k][0] == (i, t, p):
                kept.append(line)
        out.append((i, (t or "").count("\n") + 1, "\n".join(kept)))
    return sorted(out, key=str)


def run(df, min_docs, keep, **kw):
    out = L.apply_bitmaps(df, L.keep_bitmaps(df, min_docs=min_docs, keep=keep, **kw))
    assert out.columns[:len(df.columns)] == df.columns
    rows = [(r.doc_id, r["_ld_n_lines"], r["_ld_kept"]) for r in out.collect()]
    for r in out.collect():
        assert r["_ld_n_lines"] - r["_ld_n_dropped"] == (
            0 if r["_ld_n_dropped"] == r["_ld_n_lines"] else r["_ld_kept"].count("\n") + 1)
    return sorted(rows, key=str)


def test_odd_rows(make, odd_rows):
    for min_docs, keep in ((2, "none"), (3, "none"), (2, "first"), (100, "none")):
        assert run(make(odd_rows), min_docs, keep) == brute(odd_rows, min_docs, keep)


def test_only_ascii_is_lowered_and_stripped(make):
    rows = [(1, "ÉCOLE"), (2, "école"), (3, " A b\t"), (4, "\x0ba B\r"), (5, " a b")]
    assert run(make(rows), 2, "none") == brute(rows, 2, "none")


def test_min_chars(make):
    rows = [(i, f"ab\nabc\ntail{i}") for i in range(4)]
    assert run(make(rows), 3, "none", min_chars=3) == brute(rows, 3, "none", 3)


def test_empty_table(make):
    assert run(make([]), 2, "none") == []


def test_runs_are_a_bitmap(make):
    rows = [(i, f"a{i}\nx\nb{i}\nx\nx\nc{i}") for i in range(3)]
    got = L.keep_bitmaps(make(rows), min_docs=3).collect()
    assert {tuple(tuple(r) for r in g.keep_runs) for g in got} == {((0, 1), (2, 1), (5, 1))}
    assert {(g.n_lines, g.n_dropped) for g in got} == {(6, 3)}


def test_hash_of_kept_text(make):
    out = run(make([(i, "same") for i in range(3)]), 3, "none")
    assert hashlib.sha256(out[0][2].encode()).hexdigest() == hashlib.sha256(b"").hexdigest()
