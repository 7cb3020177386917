import random

from hypothesis import given, settings
from hypothesis import strategies as st

from sievekit.llm import token_counts as T
from sievekit.llm.queries import vocabulary_path


def greedy(word, first, later):
    n, at, known = 0, 0, first
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return 1
        n, at, known = n + 1, end, later
    return n


pieces = st.sets(st.binary(min_size=1, max_size=4).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=14)


@settings(max_examples=150, deadline=None)
@given(pieces, pieces, st.lists(st.integers(0, 2), max_size=14))
def test_equals_greedy_longest_match(first, later, letters):
    word = bytes(97 + x for x in letters)
    assert T.LongestMatch(first, later).count(word) == greedy(word, first, later)
    assert T.LongestMatch(first).count(word) == greedy(word, first, first)


def test_documents(spark, make, odd_rows):
    vocabulary = T.byte_level_vocabulary(vocabulary_path("byte_bpe_50k.json"))
    assert len(vocabulary) == 50256 and b" the" in vocabulary
    rng = random.Random(1)
    rows = odd_rows + [(100, "".join(rng.choice("thersäñ あ\U0001f600.") for _ in range(3000))), (101, "x" * 30_000)]
    got = T.token_counts(make(rows), vocabulary, remembered=50).collect()
    known = set(vocabulary)
    want = []
    for i, t in rows:
        words = (t or "").encode().split()
        counts = {w: greedy(b" " + w, known, known) if len(w) < 2000 else None for w in set(words)}
        long = T.LongestMatch(vocabulary)
        want.append((i, len((t or "").encode()), len(words),
                     sum(counts[w] if counts[w] is not None else long.count(b" " + w) for w in words)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert T.token_counts(make([]), vocabulary).count() == 0
