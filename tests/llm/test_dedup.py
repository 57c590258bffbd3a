"""Exact copies, near copies and repeated strings against brute force."""

import random

import numpy as np
import pytest

from tallymill.llm import jaccard, radix_dedup, suffix_dedup
from tallymill.llm.bwt import window_groups

rnd = random.Random(3)
WORDS = [f"w{i}" for i in range(400)]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_copies(documents):
    long = "x" * 30000
    rows = [(1, "Abc"), (2, "aBC"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, long), (8, long), (9, long + "y"), (10, long[:-1] + "y"), (11, "abc ")]
    rows += [(20 + i, "the same text " * 3) for i in range(40)]
    rows += [(70, "twice"), (70, "twice"), (None, "no id"), (None, "NO ID"), (71, "no id")]
    got = radix_dedup.dedup(documents(rows, "keep_id string, grp long, digit long")).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, text in rows:
        groups.setdefault(lower(text), []).append(i)
    for r in got:
        ids = groups[lower(r.text)]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    for text, _ in groups.items():
        assert sum(r.kept for r in got if lower(r.text) == text) == 1


def test_exact_copies_of_nothing(documents):
    assert radix_dedup.dedup(documents([])).count() == 0


def brute_components(rows, width, percent):
    sets = {}
    for i, text in rows:
        words = lower(text).encode().split()
        made = {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
        sets.setdefault(i, []).append(made)
    label = {i: i for i in sets if i is not None}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                if a != b and label[a] != label[b] and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_components(documents, width, percent):
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "One TWO"), (5, "one two three")]
    at = 6
    for size in (8, 12, 30, 80):
        base = rnd.choices(WORDS, k=size)
        for edits in range(9):
            text = list(base)
            for _ in range(edits):
                text[rnd.randrange(size)] = rnd.choice(WORDS)
            rows.append((at, " ".join(text)))
            at += 1
    passage = rnd.choices(WORDS, k=40)
    rows += [(at + i, " ".join(passage + rnd.choices(WORDS, k=rnd.randint(3, 15)))) for i in range(25)]
    rows += [(None, rows[10][1]), (7, rows[-1][1])]
    label = brute_components(rows, width, percent)
    got = jaccard.components_of(documents(rows), width, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else label[r.doc_id]), r


def test_components_of_nothing(documents):
    assert jaccard.components_of(documents([])).count() == 0


def test_linked_sets_share_enough_first_tokens():
    draw = np.random.default_rng(1)
    for percent in (80, 85):
        for n in (1, 5, 6, 7, 11, 40, 300, 900):
            for _ in range(40):
                x = np.unique(draw.integers(0, 1 << 63, n, np.uint64))
                y = np.unique(np.r_[x[draw.random(n) > 0.1], draw.integers(0, 1 << 63, int(n * draw.random() * 0.12), np.uint64)])
                if len(y) and jaccard.linked(x, y, percent):
                    shared = len(np.intersect1d(jaccard.prefix(x, percent), jaccard.prefix(y, percent)))
                    assert shared >= max(jaccard.least_shared(len(x), percent), jaccard.least_shared(len(y), percent)) >= 1


def test_links_come_from_the_matrix(documents, monkeypatch):
    """Near copies of which no two are equal: nothing is linked once the groups are kept shut."""
    base = [rnd.choices(WORDS, k=60) for _ in range(6)]
    rows = [(10 * i + j, " ".join([*words[: 50 + j], *rnd.choices(WORDS, k=2)])) for i, words in enumerate(base) for j in range(8)]
    label = brute_components(rows, 4, 85)
    assert len(set(label.values())) < len(rows) / 4
    found = {r.doc_id: r.component_id for r in jaccard.components_of(documents(rows), 4, 85).collect()}
    assert found == label
    monkeypatch.setattr(jaccard, "_overlap", lambda x, y: 0)
    monkeypatch.setattr(jaccard, "_open", lambda percent, best: lambda batches: iter(()))
    shut = {r.doc_id: r.component_id for r in jaccard.components_of(documents(rows), 4, 85).collect()}
    assert all(i == c for i, c in shut.items())


@pytest.mark.parametrize("group", [2, 5])
def test_families_larger_than_a_group(documents, monkeypatch, group):
    """A chain of near copies, and copies of one text with an edit each, in many small groups."""
    monkeypatch.setattr(jaccard, "GROUP", group)
    words = rnd.choices(WORDS, k=400)
    rows = [(i, " ".join(words[3 * i : 3 * i + 100])) for i in range(60)]
    for i in range(60, 130):
        text = list(words[300:380])
        text[rnd.randrange(80)] = f"edit{i}"
        rows.append((i, " ".join(text)))
    label = brute_components(rows, 4, 85)
    got = jaccard.components_of(documents(rows, "a long, b long, node long, tokens string, label long"), 4, 85)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r.doc_id: r.component_id for r in got.collect()} == label


def test_groups_settle_over_batches():
    """Rows of a signature that go through several batches, in every way of cutting them."""
    import pyarrow as pa

    rows = [(1, 5, 5, False), (2, 3, 3, False), (2, 4, 4, False), (2, 9, 9, False), (3, 1, 1, True), (4, 2, 2, False), (4, 2, 2, False), (5, 1, 1, False), (5, 6, 6, False)]
    wanted = {(2, 3, 3), (2, 4, 3), (2, 9, 3), (3, 1, 1), (5, 1, 1), (5, 6, 5 - 4)}
    for cut in range(1, len(rows)):
        parts = [rows[i : i + cut] for i in range(0, len(rows), cut)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in p]) for i in range(4)], ["sig", "node", "leader", "shared"]) for p in parts]
        got = [tuple(d.values()) for b in jaccard._together(iter(batches)) for d in b.to_pylist()]
        assert set(got) == wanted and len(got) == len(wanted), cut


def test_windows_by_interval_expansion():
    for _ in range(60):
        least, letters = rnd.choice([2, 3, 5]), rnd.choice([b"ab", b"abc", bytes(range(256))])
        strings = [bytes(rnd.choices(letters, k=rnd.randint(0, 25))) for _ in range(rnd.randint(1, 6))]
        strings.append(strings[0])
        windows, numbers = {}, {}
        for s, own in zip(strings, window_groups(strings, least), strict=True):
            for i, v in enumerate(own):
                assert windows.setdefault(s[i : i + least], v) == v and numbers.setdefault(v, s[i : i + least]) == s[i : i + least]


def brute_repeats(rows, least):
    seen, out = set(), []
    for _, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - least + 1):
            w = data[k : k + least]
            if w in seen:
                gone[k : k + least] = b"\1" * least
            seen.add(w)
        out.append(bytes(c for c, g in zip(data, gone, strict=True) if not g))
    return out


def texts_with_passages():
    letters = "abcdefgh éü"
    passages = ["".join(rnd.choices(letters, k=k)) for k in (60, 99, 100, 130, 400)]
    rows = [(0, None), (1, ""), (2, "ab" * 400), (3, "z" * 350), (4, "z" * 120)]
    for i in range(5, 60):
        parts = ["".join(rnd.choices(letters, k=rnd.randint(0, 80))) + rnd.choice(passages) for _ in range(rnd.randint(1, 5))]
        rows.append((i, "".join(parts)))
    return rows + [(60, rows[20][1]), (61, rows[20][1])]


@pytest.mark.parametrize("most", [suffix_dedup.MOST, 5, 1])
def test_repeated_strings(documents, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    rows = texts_with_passages()
    got = {r.doc_id: r for r in suffix_dedup.remove(documents(rows, "spans long, doc long")).collect()}
    for (i, text), kept in zip(rows, brute_repeats(rows, 100), strict=True):
        assert bytes(got[i].kept_bytes) == kept, i
        assert sum(s.end - s.start for s in got[i].spans) == len((text or "").encode()) - len(kept)


@pytest.mark.parametrize("step", suffix_dedup._steps(100))
def test_pieces_of_segments(step):
    """Each window of a segment is in one piece, and equal windows are in pieces of one digest."""
    passage = bytes(rnd.choices(b"abcd", k=160))
    digests = {}
    for _ in range(40):
        a, b = sorted((rnd.randint(0, 60), rnd.randint(100, 160)))
        data = np.frombuffer(bytes(rnd.choices(b"xyz", k=90)) + passage[a:b] + bytes(rnd.choices(b"xyz", k=90)), np.uint8)
        for anchor, _, at, more in suffix_dedup.anchors(data, 100):
            lengths = more + 100
            joined = np.concatenate([data[p : p + k] for p, k in zip(at, lengths, strict=True)])
            owner, first, last, digest = suffix_dedup._pieces(anchor, joined, lengths, 100, step)
            assert sorted(at[o] + i for o, f, t in zip(owner, first, last, strict=True) for i in range(f, t + 1)) == list(range(len(data) - 99))
            for o, f, t, d in zip(owner, first, last, digest, strict=True):
                assert t - f < step
                for i in range(at[o] + f, at[o] + t + 1):
                    assert digests.setdefault(data[i : i + 100].tobytes(), d) == d


def test_no_documents_have_no_repeats(documents):
    assert suffix_dedup.remove(documents([])).collect() == []


def test_repeated_ids_are_documents_of_their_own(documents):
    text = "abcdefghij" * 11 + "klm"
    got = suffix_dedup.remove(documents([(1, text), (1, text), (None, text + "!")])).collect()
    assert sorted(len(r.kept_bytes) for r in got) == sorted(map(len, brute_repeats([(None, text + "!"), (1, text), (1, text)], 100)))


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    data = np.frombuffer(bytes(rnd.choices(b"abcd", k=5000)), np.uint8)
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    covered = [i for _, _, at, more in suffix_dedup.anchors(data, 100) for a, m in zip(at, more, strict=True) for i in range(a, a + m + 1)]
    assert covered == list(range(4901))


def test_shingles_of_texts_in_pieces(monkeypatch):
    """Words have one hash wherever they stand and however a text is cut; a word may be longer than a piece."""
    words = [rnd.choice(["a", "b", "Ab", "é", "x" * 90, "\x00", "\x00\x00", "\x85y"]) for _ in range(400)]
    text = "".join(w + rnd.choice([" ", "\t\n", "  \x0b"]) for w in words)
    lowered = [w.replace("A", "a") for w in words]
    for width in (1, 4):
        whole = jaccard.shingles(text, width)
        assert len(whole) == len({tuple(lowered[i : i + width]) for i in range(len(words) - width + 1)})
        with monkeypatch.context() as m:
            m.setattr(jaccard, "PIECE", 16)
            assert list(jaccard.shingles(text, width)) == list(whole)
    assert list(jaccard.shingles("  a B\r", 4)) == list(jaccard.shingles("A b", 4)) and not len(jaccard.shingles(" \n", 4))
