"""Collocations and their parts against plain Python."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tierwatch.llm import phrases as ph, symbols
from tierwatch.llm.words import LETTERS


def plain(rows, max_words, at_least, inside, top):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) rows."""
    f, total = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, max_words + 1):
                f.update((lang, tuple(words[i:i + size])) for i in range(len(words) - size + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= at_least}
    found = collections.defaultdict(list)
    for (lang, phrase), a in candidates.items():
        longer = [b for (other, words), b in candidates.items() if other == lang and len(words) > len(phrase)
                  and any(words[i:i + len(phrase)] == phrase for i in range(len(words)))]
        if any(100 * b >= inside * a for b in longer):
            continue
        cuts = [(10 ** 6 * a * a // (f[lang, phrase[:k]] * f[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(phrase).encode(), f[lang, phrase[:k]], f[lang, phrase[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, total[lang], -s) for lang, rows in found.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def texts(seed, n):
    choose = random.Random(seed)
    words = ["a", "B", "c", "the", "é", "😀", "x y", "rare%d", "\x01"]
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", "!"]
    made = []
    for _ in range(n):
        text = "".join((w if "%" not in w else w % choose.randint(0, 99)) + choose.choice(ends)
                       for w in choose.choices(words, weights=[9, 4, 3, 9, 2, 1, 1, 2, 1], k=choose.randint(0, 60)))
        made.append((text, choose.choice(["en", "en", "de", None, ""])))
    return made + [(None, "en"), ("", None), (" . ", "fr")] + made[:5] * 3


@pytest.mark.parametrize("max_words, hot, bucket", [(3, 64, 10 ** 6), (3, 5, 50), (2, 4, 100), (4, 6, 80)])
def test_collocations_against_plain_counts(spark, monkeypatch, max_words, hot, bucket):
    monkeypatch.setattr(ph, "HOT", hot)
    monkeypatch.setattr(ph, "SUFFIXES_PER_BUCKET", bucket)
    rows = texts(max_words + hot, 50)
    docs = spark.createDataFrame([(t, g, 1, "x", 2) for t, g in rows], "text string, lang string, n int, phrase string, bucket int")
    for at_least, inside, top in ((3, 50, 40), (2, 80, 2000)):
        got = ph.collocations(docs.repartition(3), max_words, at_least, inside, top).collect()
        assert sorted(map(tuple, got)) == plain(rows, max_words, at_least, inside, top)


def test_empty_table_and_one_long_text(spark):
    docs = spark.createDataFrame([("one two three, " * 300_000, "en")], "text string, lang string")
    assert ph.collocations(docs.limit(0)).count() == 0
    got = [tuple(r) for r in ph.collocations(docs).collect()]
    assert got == [("en", 1, "one two three", 300_000, 300_000, 300_000, 900_000, 10 ** 6)]


@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=4), st.integers(1, 6)), min_size=1, max_size=60),
       st.integers(1, 12), st.integers(1, 3))
@settings(max_examples=200, deadline=None)
def test_quicksort_counts_prefixes(suffixes, at_least, shortest):
    columns = np.zeros((4, len(suffixes)), np.int32)
    counts = collections.Counter()
    for i, (words, n) in enumerate(suffixes):
        columns[:len(words), i] = words
        for size in range(shortest, len(words) + 1):
            counts[tuple(words[:size])] += n
    weights = np.array([n for _, n in suffixes])
    got = [(tuple(columns[:length, i].tolist()), int(n)) for length, at, ns in ph.frequent_prefixes(columns, weights, at_least, shortest)
           for i, n in zip(at, ns)]
    assert len(got) == len(dict(got)) and dict(got) == {k: v for k, v in counts.items() if v >= at_least}


@given(st.lists(st.tuples(st.lists(st.integers(1, 5), min_size=2, max_size=4), st.integers(1, 6)), min_size=1, max_size=40))
@settings(max_examples=150, deadline=None)
def test_routes_count_each_prefix_once(suffixes):
    """Words 1 and 2 are hot: each prefix of two words or more gets its whole count at one depth."""
    hot = np.array([False, True, True, False, False, False])
    columns = np.zeros((4, len(suffixes)), np.int64)
    wanted = collections.Counter()
    for i, (words, n) in enumerate(suffixes):
        columns[:len(words), i] = words
        for size in range(2, len(words) + 1):
            wanted[tuple(words[:size])] += n
    weights = np.array([n for _, n in suffixes])
    got, place = collections.Counter(), {}
    for depth, cols, ns in ph.routes(list(columns), weights, hot):
        for i, n in enumerate(ns.tolist()):
            words = [int(c[i]) for c in cols if c[i]]
            assert len(words) >= depth
            for size in range(max(2, depth), len(words) + 1):
                got[tuple(words[:size])] += n
                assert place.setdefault(tuple(words[:size]), (depth, tuple(words[:depth]))) == (depth, tuple(words[:depth]))
    assert got == wanted


@given(st.lists(st.lists(st.tuples(st.sampled_from(["a", "bb", "é", "z" * 9]), st.sampled_from(["", "bb", "q"]), st.integers(0, 9)),
                         min_size=1, max_size=9), min_size=1, max_size=5))
@settings(max_examples=100, deadline=None)
def test_blocks_round_trip(blocks):
    packed = []
    for block in blocks:
        words = sorted({w for row in block for w in row[:2] if w})
        place = {"": 0, **{w: i + 1 for i, w in enumerate(words)}}
        block = sorted(block, key=lambda r: place[r[0]])
        columns = [np.array([place[row[j]] for row in block]) for j in (0, 1)]
        packed.append((len(block), *symbols.pack(pa.array([w.encode() for w in words], pa.large_binary()), columns,
                                                 [np.array([row[2] for row in block])]), block))
    tables = [symbols.unpack_columns(c, 3, n) for n, _, _, c, _ in packed]
    dictionary, places = symbols.merge([symbols.unpack_words(size, s) for _, size, s, _, _ in packed])
    names = ["", *(w.decode() for w in dictionary.to_pylist())]
    assert len(set(names)) == len(names)
    for (*_, block), table, place in zip(packed, tables, places):
        assert [(names[place[a]], names[place[b]], n) for a, b, n in table.T.tolist()] == block


def test_distinct_tuples_of_wide_ranges():
    random_ = np.random.default_rng(1)
    columns = [random_.choice([0, 1, 1 << 33, (1 << 40) + 7], 500) for _ in range(4)]
    first, counts = symbols.distinct(columns)
    wanted = collections.Counter(zip(*(c.tolist() for c in columns)))
    assert {tuple(int(c[i]) for c in columns): int(n) for i, n in zip(first, counts)} == wanted
    assert sorted(wanted) == [tuple(int(c[i]) for c in columns) for i in first]


def test_words_are_told_apart_by_their_bytes():
    found = symbols.coded(pa.array(["Ab ab-AB é", None, "", "é ab"]), LETTERS)
    assert [found.dictionary[c].as_py().decode() for c in found.codes.tolist()] == ["ab", "ab", "ab", "é", "é", "ab"]
    assert found.bounds.tolist() == [0, 4, 4, 4, 6]
