import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orebed.llm import tokens
from orebed.llm.queries import REGISTRY
from orebed.llm.tokens import Encoder, Index, build_levels, key_hashes, lookup, read_documents, read_one, slots_of, word_tokenizer, write_tokens


def expected(rows):
    """(doc_id, start, n_tokens, crc) by encoding every text by itself, for rows in order."""
    tokenizer = Tokenizer.from_file(word_tokenizer())
    result, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        result.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return result


@pytest.mark.parametrize("count", [1, 2, 1000, 20_000])
def test_perfect_hash(count):
    ids = np.random.default_rng(count).permutation(np.arange(count) - count // 2)
    hashes = key_hashes(ids, np.zeros(count, bool), np.zeros(count, int))
    slots = slots_of(build_levels(hashes), hashes)
    assert sorted(slots.tolist()) == list(range(count))


def test_index_round_trip():
    ids = np.array([-5, 1, 1, 1, 7, 0, 0])
    none = np.array([0, 0, 0, 0, 0, 1, 1], bool)
    index = Index.build(ids, none, np.array([3, 1, 2, 5, 1, 1, 4]), 2)
    again = Index.unpack(b"ids" + index.pack() + b"\x01\x00")
    place, number = again.find(*again.keys())
    assert place.tolist() == [0, 3, 4, 6, 11, 12, 13] and number.tolist() == [3, 1, 2, 5, 1, 1, 4]
    absent = np.arange(1000, 3000)
    assert (again.find(absent, np.zeros(2000, bool), np.zeros(2000, int))[1] == -1).all()


def test_a_look_reads_a_few_words_only():
    """The same work for one key of a thousand and of half a million."""
    for count in (1000, 500_000):
        ids, none = np.arange(count), np.zeros(count, bool)
        index = Index.unpack(Index.build(ids, none, np.ones(count, np.int64), 2).pack() + b"\x01\x00")
        touched = []

        class Watched(np.ndarray):
            def __getitem__(self, key):
                found = np.asarray(super().__getitem__(key))
                touched.append(found.size)
                return found

        for level in index.levels:
            level.words, level.before = level.words.view(Watched), level.before.view(Watched)
        place, number = index.find(np.array([count // 3]), np.zeros(1, bool), np.zeros(1, int))
        assert (place.tolist(), number.tolist()) == ([count // 3], [1])
        assert 0 < sum(touched) <= 2 * len(index.levels)


def test_repeats_are_numbered_over_all_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "TASK_BYTES", 3000)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 500)
    texts = [f"text {n}" for n in range(40)]
    rows = [(7, text) for text in texts] + [(None, text) for text in texts] + [(n, "x") for n in (3, 3, 9)]
    write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path), word_tokenizer(), shard_bytes=1000)
    assert spark.read.parquet(f"{tmp_path}/shards").count() > 3
    found = lookup(spark, str(tmp_path), [7, None, 3, 9, 4]).collect()
    for key, number in ((7, 40), (None, 40), (3, 2), (9, 1)):
        assert sorted(row.repeat for row in found if row.doc_id == key) == list(range(number))
    tokenizer = Tokenizer.from_file(word_tokenizer())
    wanted = sorted([*tokenizer.encode(text, add_special_tokens=False).ids, 1] for text in texts)
    assert sorted(row.ids for row in found if row.doc_id is None) == wanted
    (shard,) = spark.read.parquet(f"{tmp_path}/shards").filter("low <= 3").collect()
    file = f"{tmp_path}/ids/{shard.file}"
    assert read_one(file, 3, 1).tolist() == [*tokenizer.encode("x", add_special_tokens=False).ids, 1]
    assert read_one(file, 3, 2) is None and read_one(file, 4) is None


def hard_texts():
    rng = random.Random(8)
    pieces = ["Hello", "l'été", "it's", "'s", "don't!?", "ÀÉß", "İstanbul", "áb", "́x", "naïve,", "x1y2", "...", "#tag", "日本語",
              "<|endoftext|>", "µm", "ﬁne", " nbsp ", "a\x1cb", " ", "A.B.C", "word;", "Ĳ", "ét,"]
    texts = [rng.choice([" ", "\n", "  \t"]).join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(200)]
    return texts + ["", " \n ", "word " * 5000, "".join(chr(rng.randrange(0x20, 0x2FF)) for _ in range(3000))]


@pytest.mark.parametrize("most", [400_000, 10])
def test_encoder_matches_the_library(monkeypatch, most):
    monkeypatch.setattr(tokens, "MAX_KNOWN", most)
    with open(word_tokenizer(), encoding="utf-8") as file:
        encoder = Encoder(file.read(), 2)
    tokenizer = Tokenizer.from_file(word_tokenizer())
    texts = hard_texts()
    found = [ids for place in range(0, len(texts), 7) for ids in encoder.encode([t.encode() for t in texts[place : place + 7]])]
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_tasks_of_a_worker_share_a_tokenizer():
    """Each tokenizer that has encoded something leaves memory behind, so its number must not grow with the tasks."""
    with open(word_tokenizer(), encoding="utf-8") as file:
        definition = file.read()
    first, second = Encoder(definition, 2), Encoder(definition, 4)
    assert first.tokenizer is second.tokenizer and first.places is not second.places
    texts = [text.encode() for text in hard_texts()]
    narrow, wide = first.encode(texts), second.encode(texts)
    assert [np.frombuffer(ids, "<u2").tolist() for ids in narrow] == [np.frombuffer(ids, "<u4").tolist() for ids in wide]


@pytest.mark.parametrize("shard_bytes", [1 << 24, 5000])
def test_write_and_read(spark, tmp_path, monkeypatch, shard_bytes):
    monkeypatch.setattr(tokens, "TASK_BYTES", 40_000)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 2000)
    rows = [(i * 3 - 50, text) for i, text in enumerate(hard_texts())] + [(10**15, None), (-(10**17), "first")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("file", F.lit("x")).orderBy(F.rand(1))
    write_tokens(docs, str(tmp_path / "set"), word_tokenizer(), shard_bytes=shard_bytes)
    found = sorted(tuple(r) for r in read_documents(spark, str(tmp_path / "set")).collect())
    assert found == expected(sorted(rows, key=lambda r: r[0]))
    tokenizer = Tokenizer.from_file(word_tokenizer())
    picked = {r.doc_id: r.ids for r in lookup(spark, str(tmp_path / "set"), [-50, 10**15, -(10**17), 1, 10**9]).collect()}
    assert picked == {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t in rows if d in (-50, 10**15, -(10**17), 1)}


def test_repeated_and_null_ids(spark, tmp_path):
    rows = [(5, "one"), (5, "one"), (5, "another one"), (None, "no id"), (None, "no id"), (2, "two"), (None, None)]
    write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path / "set"), word_tokenizer())
    found = sorted((tuple(r) for r in read_documents(spark, str(tmp_path / "set")).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == [2, 5, 5, 5, None, None, None]
    assert [r[1] for r in found] == np.cumsum([0, *[r[2] for r in found]])[:-1].tolist()
    plain = expected(rows)
    assert sorted((r[0] or 0, r[2], r[3]) for r in found) == sorted((r[0] or 0, r[2], r[3]) for r in plain)
    assert sorted(r.repeat for r in lookup(spark, str(tmp_path / "set"), [5, 6]).collect()) == [0, 1, 2]


def test_run_ids_that_look_like_file_numbers(spark, tmp_path, monkeypatch):
    """Spark puts a random id into file names: every thirteenth or so has a group of c and digits."""
    monkeypatch.setattr(tokens, "GROUP_BYTES", 500)
    files = tokens._files

    def renamed(*args):
        name = F.regexp_replace("file", r"^(part-\d+-).*(-c\d+[^-]*)$", f"$1{run}$2")
        return files(*args).withColumn("file", name)

    monkeypatch.setattr(tokens, "_files", renamed)
    rows = [(i, f"text {i} " * 20) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for place, run in enumerate(["5b0c9a1e-c12f-4d3a-9c55-0a0ffee12345", "5b0c9a1e-12cf-4d3a-9c55-c7ffee123456"]):
        path = f"{tmp_path}/{place}"
        write_tokens(docs, path, word_tokenizer(), shard_bytes=1000)
        shards = spark.read.parquet(f"{path}/shards").select("task", "shard", "file").collect()
        assert len({(s.task, s.shard) for s in shards}) == len({s.file for s in shards}) == len(shards) > 3
        assert sorted(tuple(r) for r in read_documents(spark, path).collect()) == expected(rows)


def test_shards_are_read_one_at_a_time(spark, tmp_path, monkeypatch):
    held, store = {}, tokens.stored

    def noted(df, label, *args, **options):
        held[label] = spark.conf.get(tokens.BATCH)
        return store(df, label, *args, **options)

    monkeypatch.setattr(tokens, "stored", noted)
    before = spark.conf.get(tokens.BATCH)
    write_tokens(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), str(tmp_path), word_tokenizer())
    assert sorted(tuple(r) for r in read_documents(spark, str(tmp_path)).collect()) == expected([(1, "a b")])
    assert held == {"shards": "1", "found": "1"} and spark.conf.get(tokens.BATCH) == before


def test_empty_texts_weigh_something(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "TASK_BYTES", 40_000)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 2000)
    rows = [(None, "")] * 2000 + [(i, None) for i in range(1000)]
    write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), str(tmp_path), word_tokenizer(), shard_bytes=20_000)
    shards = spark.read.parquet(f"{tmp_path}/shards").collect()
    assert max(shard.documents for shard in shards) < 500 and len({shard.task for shard in shards}) > 2
    found = sorted((r.start, r.n_tokens, r.doc_id) for r in read_documents(spark, str(tmp_path)).collect())
    assert found == [(i, 1, i if i < 1000 else None) for i in range(3000)]


def test_empty_table(spark, tmp_path):
    write_tokens(spark.createDataFrame([], "doc_id bigint, text string"), str(tmp_path / "set"), word_tokenizer())
    assert read_documents(spark, str(tmp_path / "set")).count() == 0
    assert lookup(spark, str(tmp_path / "set"), [1]).count() == 0


def test_end_id_of_other_bytes(spark, tmp_path):
    with pytest.raises(ValueError):
        write_tokens(spark.createDataFrame([], "doc_id bigint, text string"), str(tmp_path / "set"), word_tokenizer(), end_id=200)


def test_query(spark, sf_dir):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(tuple(r) for r in REGISTRY["op5_token_output"](spark, sf_dir).collect()) == expected(rows)
