import hashlib
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.llm.merkle import SECTION, differences, edits, fingerprints, likeness, shared, tree


def expected(rows):
    """By brute force on rows in the order of ids."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        a, b, c = tree(text), tree(edited), tree(following)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.digest.hex(), b.digest.hex(),
                    likeness(a, b), likeness(a, c)))
    return out


def sample(n, seed=3):
    rng = random.Random(seed)
    vowels = ["a", "é", "o", "nd", "th", "er.", "is", "x,", "\n", "  ", "\n\n"]
    return [(i * 3 - 20, " ".join(rng.choices(vowels, k=rng.randint(0, 300)))) for i in range(n)]


@pytest.mark.parametrize("n,buckets", [(1, 1), (2, 4), (3, 1), (97, 8), (97, 40)])
def test_pairs_with_the_next_document(docs_of, n, buckets):
    rows = sample(n)
    got = sorted(tuple(r) for r in fingerprints(docs_of(rows[::-1]), buckets=buckets).collect())
    assert got == expected(rows)


def test_odd_rows(odd_docs, clashing):
    for docs in (odd_docs, clashing):
        out = fingerprints(docs, buckets=4).collect()
        assert len(out) == docs.count()
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
        empties = {r["fingerprint"] for r in out if r["n_chars"] == 0}
        assert len(empties) == 1


def test_empty_table(docs_of):
    assert fingerprints(docs_of([])).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab. \n", max_size=80), st.text(alphabet="ab. \n", max_size=80))
def test_roots_test_equality(a, b):
    x, y = tree(a), tree(b)
    assert (x.digest == y.digest) == (a == b)
    assert likeness(x, y) == pytest.approx(likeness(y, x))
    assert (likeness(x, y) == 1.0) >= (a == b)


def test_differing_branches_locate_the_edit():
    lines = [f"Line {i} has some words, and a few more of them than {i * i}." for i in range(200)]
    text = "\n".join(lines)
    changed = text.replace("Line 77 has some", "Line 77 had some")
    spans = edits(tree(changed), tree(text))
    at = changed.index("Line 77 had")
    assert spans and all(at <= s and e <= at + len(lines[77]) + 2 for s, e in spans)
    assert likeness(tree(changed), tree(text)) > 0.99
    assert edits(tree(text), tree(text)) == []


def test_likeness_follows_the_share_of_equal_text():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(800)]
    text, other = " ".join(words), " ".join(reversed(words))
    half = text[:len(text) // 2] + other[:len(text) // 2][::-1]
    assert 0.4 < likeness(tree(text), tree(half)) < 0.55


@pytest.mark.parametrize("kept,of", [(190, 267), (250, 400), (256, 257), (300, 1200)])
def test_paragraphs_are_cut_alike_at_every_length(kept, of):
    """The side that is kept and the other may lie on both sides of any length."""
    rng = random.Random(of)
    text = " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 12))) for _ in range(of))[:of]
    short = text[:kept]
    assert likeness(tree(text), tree(short)) == pytest.approx(kept / of, abs=12 / of)
    assert likeness(tree(short), tree(text)) == likeness(tree(text), tree(short))


def test_cut_words_count_their_characters_once():
    a, b = tree("x" * 800 + "y" * 200), tree("x" * 800 + "z" * 200)
    assert likeness(a, b) == pytest.approx(0.8, abs=0.01)
    assert edits(a, b) == [(800, 1001)]


def root_by_hand(text):
    """The root from nothing but the stated rule."""
    def digest(data):
        return hashlib.blake2b(data, digest_size=16).digest()
    lines = [digest(b"l" + line.encode()) for line in text.split("\n")]
    sections, begun = [], 0
    for i, (line, d) in enumerate(zip(text.split("\n"), lines, strict=True)):
        if d[0] % SECTION == 0 or not line.strip() or i + 1 == len(lines):
            sections.append(digest(b"s" + b"".join(lines[begun:i + 1])))
            begun = i + 1
    return digest(b"r" + b"".join(sections))


def common_subsequence(a, b):
    """Length of the longest common subsequence of characters, by the full table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["ab", "b. ", "c ", " ", "\n", "abcdefghij ", "d, "]), max_size=30),
       st.lists(st.sampled_from(["ab", "b. ", "c ", " ", "\n", "abcdefghij ", "d, "]), max_size=30))
def test_what_is_shared_is_one_sequence_by_brute_force(left, right):
    a, b = "".join(left), "".join(right)
    x, y = tree(a), tree(b)
    assert x.digest == root_by_hand(a)
    spans = list(differences(x, y))

    def outside(text, spans):
        at, out = 0, []
        for start, end in spans:
            assert at <= start <= end
            out.append(text[at:start])
            at = end
        return "".join([*out, text[at:]])

    ours, theirs = a + "\n", b + "\n"
    same = outside(ours, [s[:2] for s in spans])
    assert same == outside(theirs, [s[2:] for s in spans])
    assert shared(x, y) == len(same) <= common_subsequence(ours, theirs)
    assert (likeness(x, y) == 1.0) == (a == b) == (not edits(x, y))
    assert likeness(x, y) == likeness(y, x)


@pytest.mark.parametrize("joint", [" ", "\n", ". ", "\n\n"])
def test_the_same_words_in_another_order_are_not_alike(joint):
    words = [f"word{i:03d}" for i in range(60)]
    rng = random.Random(5)
    text = joint.join(words)
    for other in (words[::-1], rng.sample(words, len(words)), words[30:] + words[:30]):
        a, b = tree(text), tree(joint.join(other))
        assert likeness(a, b) < 0.6 and edits(a, b)


def test_an_insertion_and_a_removal_are_told_apart():
    words = [f"w{i}" for i in range(500)]
    text, longer = " ".join(words), " ".join([*words[:200], "new", "words", *words[200:]])
    at = len(" ".join(words[:200])) + 1
    assert edits(tree(longer), tree(text)) == [(at, at + len("new words "))]
    assert edits(tree(text), tree(longer)) == [(at, at)]
    assert likeness(tree(text), tree(longer)) == (len(text) + 1) / (len(longer) + 1)


def test_very_long_texts_of_repeated_lines_are_compared_in_little_time():
    begun = time.perf_counter()
    a, b = tree("same line\n" * 100_000), tree("other\n" + "same line\n" * 99_000 + "same word " * 50_000)
    assert 0 < likeness(a, b) < 1
    assert time.perf_counter() - begun < 20
