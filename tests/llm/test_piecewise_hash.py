import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from sievekit.llm import piecewise_hash as H


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(st.text("abcd", max_size=80), st.text("abcd", max_size=80))
def test_edit_distance(a, b):
    assert H._common_length(a, b) == lcs(a, b)


def brute_fingerprint(data):
    """The definition, byte by byte."""
    if not data:
        return "3::"
    roll = []
    for i in range(len(data)):
        h = sum((data[i - j] + 1) * pow(0x01000193, j, 2 ** 32) for j in range(min(7, i + 1))) % 2 ** 32
        h ^= h >> 15
        h = h * 0x2C1B3C6D % 2 ** 32
        roll.append(h ^ h >> 12)

    def signature(size):
        out, total = "", 0
        for i, r in enumerate(roll):
            total += r
            if r % size == size - 1 or i == len(roll) - 1:
                out += "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"[
                    total * 0x9E3779B97F4A7C15 % 2 ** 64 >> 58]
                total = 0
        return out

    size = 3
    while sum(r % (2 * size) == 2 * size - 1 for r in roll) >= 32:
        size *= 2
    return f"{size}:{signature(size)}:{signature(2 * size)}"


def test_fingerprint_by_definition():
    rng = random.Random(1)
    for n in (0, 1, 5, 6, 7, 8, 50, 400, 5000):
        data = bytes(rng.choice(b"etaoin shrdlu") for _ in range(n))
        assert H.fingerprint(data) == brute_fingerprint(data)


def test_edits_move_a_fingerprint_little():
    rng = random.Random(2)
    text = "".join(rng.choice("etaoin shrdlu\n") for _ in range(8000))
    small = text[:4000] + "an insertion" + text[4000:]
    other = "".join(rng.choice("etaoin shrdlu\n") for _ in range(8000))
    mark = lambda t: H.fingerprint(t.encode())
    assert H.likeness(mark(text), mark(small)) > 0.9
    assert H.likeness(mark(text), mark(H.edited(text, other))) > 0.3
    assert H.likeness(mark(text), mark(other)) < 0.1
    assert H.likeness(mark(text), mark(text * 2)) > 0.3          # block sizes that differ twofold
    assert H.likeness("3::", mark(text)) == 0 and H.likeness("3::", "3::") == 1


def test_neighbours(spark, make, odd_rows):
    for rows in (odd_rows, [(5, "alone")], [(i, f"text number {i} " * (i % 9)) for i in range(300)]):
        got = H.neighbour_likeness(make(rows)).collect()
        assert len(got) == len(rows)
        order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
        texts = {}
        for k in order:
            texts.setdefault(rows[k][0], set()).add(rows[k][1] or "")
        if len(texts) < len(rows):
            assert {len(rows[k][1] or "") for k in order} == {r.n_chars for r in got}
            continue
        following = [order[(n + 1) % len(order)] for n in range(len(order))]
        by_id = {r.doc_id: r for r in got}
        for k, f in zip(order, following):
            t, nxt, r = rows[k][1] or "", rows[f][1] or "", by_id[rows[k][0]]
            changed = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
            assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
            assert r.fingerprint == H.fingerprint(t.encode()) and r.edited_fingerprint == H.fingerprint(changed.encode())
            assert r.near_next == H.likeness(r.fingerprint, H.fingerprint(nxt.encode()))
            assert 0 <= r.near_edited <= 1
    assert H.neighbour_likeness(make([])).count() == 0


def test_fingerprint_column(make, odd_rows):
    got = H.fingerprints(make(odd_rows)).collect()
    assert all(r.fingerprint == H.fingerprint((r.text or "").encode()) for r in got)
