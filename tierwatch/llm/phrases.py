"""Collocations: phrases whose words stand together more often than their parts lead one to expect.

Texts are lower-cased in A-Z and cut into pieces at ``[.,;:!?\\x0A-\\x0D]``, pieces into words at spaces and
tabs. All counts are per language. A candidate has 2 to ``max_words`` words and at least ``at_least`` occurrences
``a``. Cutting it in two parts that occur ``l`` and ``r`` times scores ``floor(1000000 a a / (l r))``; its lowest
score counts, of equal ones that of the shortest first part. A candidate that stands inside a longer one which has half
of its occurrences or more is dropped.

Method. Words are counted first. Then every place of a text is a *suffix*, a pointer to its first
``max_words`` words, and suffixes are routed by their leading words: by the first; by the first two where the
first is one of the few words that make up a ``1 / HOT`` of all; by three where the second is as well, and so on.
Whatever the corpus repeats, no task gets more of it than a small share. A task sorts its suffixes by
multikey three-way quicksort to the maximum depth, all partitions of a round at once: the size of an equal-partition is the
count of its prefix, and partitions smaller than ``at_least`` are abandoned, sorted or not.

Before they travel, equal suffixes of a chunk of texts are counted together and cut at words that are
rare in the whole corpus, as far as a bitmap of fixed size tells; words that share a frequent word's bit
are merely kept. Suffixes travel as packed blocks with their own exact dictionaries. The driver sees at most ``HOT``
words and the bitmap.

Edge cases: a null language is ``und``; a null or empty text, or one without words, counts nothing; repeated rows and null
ids all count; an empty table gives an empty result. Only the text and the language are read, so other columns cannot clash.
A very long text is a chunk of its own; a word of any length is a word. Scores are exact up to 10 ** 15 occurrences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tierwatch.llm.registered import query, table
from tierwatch.llm.symbols import Coded, coded, distinct, gathered, merge, pack, runs, spread, unpack_columns, unpack_words
from tierwatch.llm.words import byte_class
from tierwatch.session import materialize

MAX_WORDS, AT_LEAST, INSIDE_PERCENT, TOP = 3, 10, 50, 2000
NO_LANGUAGE = "und"
#: Words of a language that make up a larger share of the corpus than one in so many are routed with the next word.
HOT = 64
#: Bits of the map of frequent words (4 MB).
BITS = 1 << 25
_MAP_BLOCK = 32_768  # bits in one value of Spark's bitmap functions
#: Suffixes that one task is meant to sort; only splits the work.
SUFFIXES_PER_BUCKET = 2_500_000

_PIECE_ENDS = byte_class([(ord(c), ord(c)) for c in ".,;:!?"] + [(0x0A, 0x0D)])
_WORD = ~(_PIECE_ENDS | byte_class([(0x20, 0x20), (0x09, 0x09)]))
_BLOCK = "lang string, depth int, bucket int, n int, spelled_bytes int, spelled binary, columns binary"


class _Chunk:
    """The words of a chunk as symbols from 1, a symbol being a word of a language."""

    def __init__(self, rows: pa.Table) -> None:
        self.words: Coded = coded(rows["text"], _WORD)
        langs = rows["lang"].combine_chunks().fill_null(NO_LANGUAGE).dictionary_encode()
        of_row = self.words.rows()
        kinds = max(len(self.words.dictionary), 1)
        both = pa.array(langs.indices.to_numpy().astype(np.int64)[of_row] * kinds + self.words.codes).dictionary_encode()
        self.symbols = both.indices.to_numpy().astype(np.int64) + 1
        keys = both.dictionary.to_numpy()
        self.lang_of, self.word_of = keys // kinds, keys % kinds
        self.langs, self.dictionary = langs.dictionary, self.words.dictionary
        ended = np.cumsum(_PIECE_ENDS[self.words.data], dtype=np.int32)
        self.piece = (ended[self.words.starts] if len(ended) else np.zeros(0, np.int64)) + of_row

    def keys(self) -> list[tuple[str, bytes]]:
        langs = self.langs.to_pylist()
        return list(zip([langs[i] for i in self.lang_of.tolist()], self.dictionary.take(pa.array(self.word_of)).to_pylist()))

    def hashes(self) -> np.ndarray:
        """CRC of language, space and word, as :func:`_crc` has it; 0 for no symbol."""
        first = [zlib.crc32(lang.encode() + b" ") for lang in self.langs.to_pylist()]
        words = self.dictionary.take(pa.array(self.word_of)).to_pylist()
        return np.array([0, *(zlib.crc32(w, first[i]) for i, w in zip(self.lang_of.tolist(), words))], np.int64)


def _crc():
    return F.crc32(F.concat("lang", F.lit(" "), "word").cast("binary"))


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, word, n`` of every word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, 1):
            chunk = _Chunk(rows)
            n = np.bincount(chunk.symbols, minlength=1)[1:]
            yield pa.RecordBatch.from_arrays(
                [chunk.langs.take(pa.array(chunk.lang_of)), chunk.dictionary.take(pa.array(chunk.word_of)).cast(pa.large_string()).cast(pa.string()),
                 pa.array(n.astype(np.int64))], names=["lang", "word", "n"])

    return _texts(docs, text_col, lang_col).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _frequent_bits(words: DataFrame, at_least: int) -> np.ndarray:
    """A bit for each value of the CRC modulo ``BITS`` that a frequent word has."""
    bit = _crc() % BITS + 1
    maps = words.filter(F.col("n") >= at_least).select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    found = np.zeros(BITS // 8, np.uint8)
    for row in maps.collect():
        at = (row["block"] - 1) * _MAP_BLOCK // 8
        found[at:at + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    return found


def suffix_columns(symbols: np.ndarray, piece: np.ndarray, frequent: np.ndarray, depth: int) -> list[np.ndarray]:
    """The symbols from each place on, 0 after the end of the piece or from a rare word on; only places with two or more."""
    columns = [np.where(frequent[symbols], symbols, 0)]
    for j in range(1, depth):
        following = np.zeros_like(symbols)
        following[:-j] = np.where((piece[j:] == piece[:-j]) & (columns[-1][:-j] > 0), columns[0][j:], 0)
        columns.append(following)
    kept = columns[1] > 0
    return [c[kept] for c in columns]


def routes(columns: list[np.ndarray], counts: np.ndarray, hot: np.ndarray) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """By the number of leading words that say where a suffix goes: the suffixes and their counts.

    A suffix whose leading words are all hot goes with one word more, as far as there are words. Its shorter prefixes, of which
    there are few, go by themselves; at a depth, only prefixes of that many words or more are counted.
    """
    depth = np.ones(len(counts), np.int64)
    leading_hot = np.ones(len(counts), bool)
    for column in columns[:-1]:
        leading_hot &= hot[column]
        depth += leading_hot
    none = np.zeros(0, np.int64)
    for d in range(1, len(columns) + 1):
        here = (depth == d) & (columns[d - 1] > 0)
        deeper = depth > d if d > 1 else np.zeros(len(counts), bool)
        short = [c[deeper] if j < d else np.zeros(int(deeper.sum()), np.int64) for j, c in enumerate(columns)]
        totals = none
        if len(short[0]):
            first, _ = distinct(short)
            order = np.lexsort(short[::-1])
            cuts = runs(*(c[order] for c in short))[:-1]
            totals = np.add.reduceat(counts[deeper][order], cuts)
            short = [c[first] for c in short]
        yield d, [np.concatenate([c[here], s]) for c, s in zip(columns, short)], np.concatenate([counts[here], totals])


def suffix_blocks(docs: DataFrame, words: DataFrame, max_words: int = MAX_WORDS, at_least: int = AT_LEAST, text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """Packed blocks of counted suffixes with the language, depth and bucket they are routed to."""
    total = words.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // SUFFIXES_PER_BUCKET))
    share = -(-total // HOT)
    hot_words = {(r["lang"], r["word"].encode()) for r in words.filter((F.col("n") >= share) & (F.col("n") >= at_least)).collect()}
    bits = docs.sparkSession.sparkContext.broadcast(_frequent_bits(words, at_least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, 1):
            chunk = _Chunk(rows)
            hashes = chunk.hashes()
            at = hashes % BITS
            frequent = (bits.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            frequent[0] = False
            hot = np.array([False, *(k in hot_words for k in chunk.keys())])
            columns = suffix_columns(chunk.symbols, chunk.piece, frequent, max_words)
            if not len(columns[0]):
                continue
            first, counts = distinct(columns)
            made: list[tuple] = []
            for depth, cols, n in routes([c[first] for c in columns], counts, hot):
                if len(n):
                    made += _blocks(chunk, depth, cols, n, hashes, buckets)
            if made:
                kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                names = [part.split()[0] for part in _BLOCK.split(", ")]
                for a in range(0, len(made), 200):
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*made[a:a + 200]), kinds)], names=names)

    return _texts(docs, text_col, lang_col).mapInArrow(run, _BLOCK)


def _blocks(chunk: _Chunk, depth: int, columns: list[np.ndarray], counts: np.ndarray, hashes: np.ndarray, buckets: int) -> Iterator[tuple]:
    bucket = (spread(*(hashes[c] for c in columns[:depth])) % np.uint64(buckets)).astype(np.int64)
    lang = chunk.lang_of[columns[0] - 1]
    order = np.lexsort((bucket, lang))  # stable: tuples stay in order
    columns, counts, bucket, lang = [c[order] for c in columns], counts[order], bucket[order], lang[order]
    words = np.concatenate([[0], chunk.word_of + 1])
    cuts, names = runs(lang, bucket), chunk.langs.to_pylist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield names[lang[a]], depth, int(bucket[a]), int(b - a), *pack(chunk.dictionary, [words[c[a:b]] for c in columns], [counts[a:b]])


def frequent_prefixes(columns: np.ndarray, weights: np.ndarray, at_least: int, shortest: int = 1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, one suffix each, and weight of the prefixes whose suffixes weigh ``at_least``; symbol 0 ends a suffix.

    Multikey three-way quicksort of pointers to the columns of ``columns``. A partition holds the suffixes that agree in
    their first ``depth`` symbols and lie between two pivots. All partitions of a round are split at once,
    each at the symbol of one of its suffixes: what is less or greater is a new partition, what is equal
    has one symbol more in common.
    """
    depths, n = columns.shape
    flat = np.ascontiguousarray(columns).ravel()
    random = np.random.default_rng(0)
    order, starts, depth = np.arange(n), np.zeros(1, np.int64), np.zeros(1, np.int64)
    if weights.sum() < at_least:
        return
    while len(order):
        sizes = np.diff(np.append(starts, len(order)))
        part = np.repeat(np.arange(len(starts)), sizes)
        symbol = flat[(depth * n)[part] + order]
        pivot = symbol[starts + (random.random(len(starts)) * sizes).astype(np.int64)]
        side = 1 + (symbol > pivot[part]).astype(np.int8) - (symbol < pivot[part]).astype(np.int8)
        # Each partition's less, equal and greater suffixes, in this order, stable.
        new = np.empty((len(starts), 3), np.int64)
        place, flags = np.empty(len(order), np.int64), []
        for s in range(3):
            flag = side == s
            new[:, s] = np.add.reduceat(flag, starts, dtype=np.int64)
            flags.append(flag)
        begins = np.concatenate([[0], np.cumsum(new.ravel())])[:-1].reshape(new.shape)
        for s, flag in enumerate(flags):
            before = np.cumsum(new[:, s]) - new[:, s]
            place[flag] = np.arange(int(flag.sum())) + np.repeat(begins[:, s] - before, new[:, s])
        moved = np.empty_like(order)
        moved[place] = order
        sums = np.concatenate([[0], np.cumsum(weights[moved])])
        weight = sums[begins + new] - sums[begins]
        equal, going = weight[:, 1], weight >= at_least
        going[:, 1] &= pivot > 0
        for length in range(shortest, depths + 1):
            found = np.flatnonzero(going[:, 1] & (depth + 1 == length))
            if len(found):
                yield length, moved[begins[found, 1]], equal[found]
        going[:, 1] &= depth + 1 < depths
        depth = np.stack([depth, depth + 1, depth], axis=1)[going]
        order = moved[np.repeat(going.ravel(), new.ravel())]
        starts = np.cumsum(new[going]) - new[going]


def frequent_phrases(blocks: DataFrame, max_words: int = MAX_WORDS, at_least: int = AT_LEAST) -> DataFrame:
    """``lang, words, phrase, n`` of the phrases of two words or more that occur ``at_least`` times."""
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        tables = [unpack_columns(r["columns"], max_words + 1, r["n"]) for r in rows]
        dictionary, places = merge([unpack_words(r["spelled_bytes"], r["spelled"]) for r in rows])
        columns = np.concatenate([p[t[:-1]] for p, t in zip(places, tables)], axis=1).astype(np.int32)
        weights = np.concatenate([t[-1] for t in tables]).astype(np.int64)
        made = [pa.table({"lang": pa.array([], pa.string()), "words": pa.array([], pa.int32()),
                          "phrase": pa.array([], pa.string()), "n": pa.array([], pa.int64())})]
        words = dictionary.cast(pa.large_string())
        for length, at, n in frequent_prefixes(columns, weights, at_least, max(2, rows[0]["depth"])):
            phrase = pc.binary_join_element_wise(*(words.take(pa.array(columns[j, at] - 1)) for j in range(length)), pa.scalar(" ", pa.large_string()))
            made.append(pa.table({"lang": pa.array([rows[0]["lang"]] * len(at), pa.string()), "words": pa.array([length] * len(at), pa.int32()),
                                  "phrase": phrase.cast(pa.string()), "n": pa.array(n)}))
        return pa.concat_tables(made)

    return blocks.groupBy("lang", "depth", "bucket").applyInArrow(run, "lang string, words int, phrase string, n long")


def scored(phrases: DataFrame, words: DataFrame, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates that do not stand inside a longer one."""
    counts = phrases.select("lang", F.col("phrase").alias("part"), "n").unionByName(words.select("lang", F.col("word").alias("part"), "n"))
    split = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", F.array_join(F.slice(split, F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice(split, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"))
    left = counts.select("lang", F.col("part").alias("left"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("part").alias("right"), F.col("n").alias("r"))
    value = F.expr("(CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0)) * CAST(1000000 AS DECIMAL(7,0)))"
                   " DIV (CAST(l AS DECIMAL(16,0)) * CAST(r AS DECIMAL(16,0)))")
    best = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).groupBy("lang", "phrase").agg(
        F.first("words").alias("words"), F.first("a").alias("a"), F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("best"))
    # Contiguous parts of two words or more of each candidate, with its count.
    size, start = F.col("size"), F.col("start")
    inner = phrases.filter("words > 2").select("lang", "phrase", "words", "n", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    inner = inner.select("lang", "phrase", "n", "size", F.explode(F.sequence(F.lit(1), F.col("words") - size + 1)).alias("start"))
    inner = inner.select("lang", F.array_join(F.slice(split, start, size), " ").alias("phrase"), "n").groupBy("lang", "phrase").agg(
        F.max("n").alias("longer"))
    free = best.join(inner, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent))
    return free.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, at_least: int = AT_LEAST, inside_percent: int = INSIDE_PERCENT, top: int = TOP,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` candidates by score, count and phrase."""
    if max_words < 2 or at_least < 2:
        raise ValueError("phrases have two words or more and occur more than once")
    words = materialize(word_counts(docs, text_col, lang_col), "words")
    phrases = materialize(frequent_phrases(suffix_blocks(docs, words, max_words, at_least, text_col, lang_col), max_words, at_least), "phrases")
    found = scored(phrases, words.filter(F.col("n") >= at_least), inside_percent)
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # The first of each of many parts of a language, so that no task ranks all of a language.
    parts = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_UPPER, _LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = f"""WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER_CASE}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
split AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
places AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM split),
grams AS (
  SELECT lang, 1 AS words, ws[i] AS phrase, NULL AS w1, NULL AS w2, NULL AS w3 FROM places
  UNION ALL SELECT lang, 2, ws[i] || ' ' || ws[i + 1], ws[i], ws[i + 1], NULL FROM places WHERE i + 1 <= len(ws)
  UNION ALL SELECT lang, 3, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2], ws[i], ws[i + 1], ws[i + 2] FROM places WHERE i + 2 <= len(ws)),
f AS (
  SELECT lang, words, phrase, any_value(w1) AS w1, any_value(w2) AS w2, any_value(w3) AS w3, count(*) AS n
  FROM grams GROUP BY lang, words, phrase),
total AS (
  SELECT lang, sum(n)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
candidates AS (
  SELECT * FROM f WHERE words >= 2 AND n >= {AT_LEAST}),
cuts AS (
  SELECT lang, phrase, words, n AS a, 1 AS k, w1 AS lp, CASE words WHEN 2 THEN w2 ELSE w2 || ' ' || w3 END AS rp FROM candidates
  UNION ALL SELECT lang, phrase, words, n, 2, w1 || ' ' || w2, w3 FROM candidates WHERE words = 3),
best AS (
  SELECT lang, phrase, words, a, l, r, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM (
      SELECT c.lang, c.phrase, c.words, a, k, x.n AS l, y.n AS r,
             (1000000::HUGEINT * a * a // (x.n::HUGEINT * y.n))::BIGINT AS score
      FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp)) WHERE nth = 1),
inner_parts AS (
  SELECT lang, part, max(n) AS longer FROM (
    SELECT lang, w1 || ' ' || w2 AS part, n FROM candidates WHERE words = 3
    UNION ALL SELECT lang, w2 || ' ' || w3, n FROM candidates WHERE words = 3) GROUP BY lang, part),
ranked AS (
  SELECT b.lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b LEFT JOIN inner_parts i ON i.lang = b.lang AND i.part = b.phrase
  WHERE longer IS NULL OR 100 * longer < {INSIDE_PERCENT} * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}"""


@query(SQL)
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading collocations of each language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))
