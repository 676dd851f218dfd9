"""Operators over whole tables: sharding, packing, token files, chat formatting."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwatch.llm import best_fit_packing, chat_format, direct_codes, sharding
from tierwatch.llm.tokens import Encoder, default_path
from tierwatch.session import scratch_path

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", "one", "same text", "same text", "é 😀 " * 40, "word " * 5000, "x"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i else None, t, f"s{i % 2}" if i != 2 else None, 1) for i, t in enumerate(TEXTS)] + [(4, "same text", "s0", 1)]
    extra = spark.createDataFrame(rows, "doc_id long, text string, source string, `group` int")
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source", F.lit(0).alias("group")).union(extra).cache()


@pytest.fixture(scope="module")
def tokens(docs):
    encoder = Encoder(default_path())
    rows = docs.collect()
    return [(r.doc_id, ids) for r, ids in zip(rows, encoder._whole([r.text or "" for r in rows]))]


@pytest.mark.parametrize("per_interval, n_shards", [(20_000, 24), (7, 24), (50, 3), (20_000, 1000)])
def test_shards_are_even_and_mixed(docs, per_interval, n_shards):
    rows = sharding.interleave(docs, n_shards, rows_per_interval=per_interval).collect()
    n = docs.count()
    assert len(rows) == n
    counts = collections.Counter(r.shard for r in rows)
    assert {counts[s] for s in range(n_shards)} <= {n // n_shards, -(-n // n_shards)}
    for shard, size in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(size))
    strata = collections.Counter(r.stratum for r in rows)
    for (shard, stratum), k in collections.Counter((r.shard, r.stratum) for r in rows).items():
        assert abs(k - strata[stratum] * counts[shard] / n) <= 2
    wanted = collections.Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()))
                                 for r in docs.collect())
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == wanted


def test_shards_do_not_depend_on_the_intervals(docs):
    placed = [{tuple(r) for r in sharding.interleave(docs, 24, rows_per_interval=k).collect()} for k in (9, 10_000)]
    assert placed[0] == placed[1]
    assert sharding.interleave(docs.limit(0)).count() == 0


def slow_pack(lengths, capacity):
    gaps, out = [], []
    squares = lambda of: sum(n * n for g, n in collections.Counter(of).items() if 0 < g < capacity)
    for size in lengths:
        best = (squares([*gaps, capacity - size]), capacity, len(gaps))
        for i, gap in enumerate(gaps):
            if gap >= size and gap < capacity:
                best = min(best, (squares([*gaps[:i], gap - size, *gaps[i + 1:]]), gap, i))
        _, gap, i = best
        gaps[i:i + 1] = [gap - size]
        out.append(capacity - gap)
    return gaps, out


@pytest.mark.parametrize("seed", range(8))
def test_sum_of_squares_against_trying_every_sequence(seed):
    capacity, draw = 12, np.random.default_rng(seed)
    lengths = np.sort(draw.integers(1, capacity + 1, 60))[::-1]
    sequence, offset = best_fit_packing.pack(lengths, capacity)
    gaps, offsets = slow_pack(lengths.tolist(), capacity)
    assert sequence.max() + 1 == len(gaps) and offset.tolist() == offsets


@pytest.mark.parametrize("group_pieces", [50_000, 40])
def test_pieces_are_whole_and_sequences_gapless(docs, tokens, group_pieces):
    rows = best_fit_packing.pack_documents(docs, group_pieces=group_pieces).collect()
    wanted = collections.Counter()
    for doc, ids in tokens:
        ids, start = np.append(ids, 0).astype("<u4"), 0
        for piece in range(-(-len(ids) // 2048)):
            end = len(ids) - (-(-len(ids) // 2048) - piece - 1) * 2048
            wanted[doc, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())] += 1
            start = end
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    placed = collections.defaultdict(list)
    for r in rows:
        placed[r.sequence_id].append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(r.length for r in rows) // 2048)
    assert len(placed) <= least * 1.1 + 8 * (1 + len(rows) // group_pieces)


def test_packing_an_empty_table(docs):
    assert best_fit_packing.pack_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("file_tokens", [direct_codes.FILE_TOKENS, 500])
def test_token_files_round_trip(spark, docs, tokens, file_tokens):
    manifest = direct_codes.write_tokens(docs, scratch_path(spark, "t"), file_tokens=file_tokens)
    rows = sorted(direct_codes.read_tokens(manifest).collect(), key=lambda r: r.start)
    wanted = collections.Counter((d, len(ids) + 1, zlib.crc32(np.append(ids, 2).astype("<u4").tobytes())) for d, ids in tokens)
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == wanted
    at = 0
    for before, r in zip([None, *rows], rows):
        assert r.start == at and (before is None or before.doc_id is None or before.doc_id <= r.doc_id)
        at += r.n_tokens
    assert direct_codes.read_tokens(direct_codes.write_tokens(docs.limit(0), scratch_path(spark, "t"))).count() == 0


@pytest.mark.parametrize("n", [0, 1, 63, 64, 511, 512, 513, 40_000])
def test_any_token_of_a_file(n):
    draw = np.random.default_rng(n)
    ids = (draw.integers(0, 1 << 32, n, dtype=np.uint64) >> draw.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
    file = direct_codes.TokenFile(direct_codes.encode_file([5, None], [ids[:n // 3], ids[n // 3:]]))
    at = draw.permutation(n)
    assert np.array_equal(file.get(at), ids[at]) and len(file) == n
    for wrong in ([n], [-1]):
        with pytest.raises(IndexError):
            file.get(np.array(wrong))


TRICKY = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<", "|", "<|", "\\", "a\nb", "", "<\\\\|x<|im_start|>", "é😀<|"]


def test_formatting_is_reversible(spark):
    rows = [(i, t, role, text, "x") for i, text in enumerate([*TRICKY, None]) for t, role in
            enumerate(("user", "assistant", None, "odd\nrole\\n<|", "assistant"))]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat_format.format_chats(chat_format.rows_as_records(table))
    read = formatted.select("conv_id", "n_unmapped", chat_format.read_turns(F.col("formatted")).alias("turns"), "formatted",
                            chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(read) == len(TRICKY) + 1
    for r in read:
        mine = [x for x in rows if x[0] == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == [(x[2] or "", x[3] or "") for x in mine] and r.n_unmapped == 0
        assert r.loss == "".join(x[3] or "" for x in mine if x[2] == "assistant")
        assert r.formatted.count("<|im_start|>") == len(mine) == r.formatted.count("<|im_end|>\n")


LAYOUTS = {
    '{"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}': [("user", "q"), ("assistant", "a")],
    '{"system": "s", "messages": [{"role": "user", "content": null}]}': [("system", "s"), ("user", "")],
    '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}': [("user", "q"), ("assistant", "a")],
    '{"prompt": "q", "completion": "a"}': [("user", "q"), ("assistant", "a")],
    '{"response": 5, "prompt": "q"}': [("user", "q"), ("assistant", "5")],
    '{"data": {"prompt": "q", "answer": {"text": "a"}}}': [("user", "q"), ("assistant", "a")],
    '{"instruction": "i", "input": "", "output": "a"}': [("user", "i"), ("assistant", "a")],
    '{"instruction": "i", "input": "n", "output": "a"}': [("user", "i\n\nn"), ("assistant", "a")],
    '{"role": "user", "text": "q"}': [("user", "q")],
    '{"unknown": 1}': None, '{"prompt": "q", "completion": "a", "more": 1}': None, '{"messages": []}': None, '5': None,
}


def test_layouts_by_fingerprint(spark):
    rows = spark.createDataFrame(list(enumerate(LAYOUTS)), "conv_id long, json string").withColumn("record", F.parse_json("json"))
    got = {r.json: r.turns and [tuple(t) for t in r.turns] for r in chat_format.canonical_turns(rows).collect()}
    assert got == LAYOUTS
    one = rows.select(F.lit(1).alias("conv_id"), F.col("conv_id").alias("turn"), "record")
    chat = chat_format.format_chats(one.union(one.filter("turn = 3"))).select(
        "n_unmapped", chat_format.read_turns(F.col("formatted")).alias("turns")).first()
    assert chat.n_unmapped == 4 and len(chat.turns) == sum(len(t or ()) for t in LAYOUTS.values()) + 2
    assert chat_format.format_chats(one.limit(0)).count() == 0


def test_formatting_runs_no_python(spark):
    plan = chat_format.op6_chat_format(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
