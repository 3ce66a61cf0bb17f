"""Classifiers on held-out rows, round trips of chat and token files, the mix, and the pipeline."""

from __future__ import annotations

import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import chat, language, mixing, quality, queries, store, tokens, toxicity
from tests.llm.conftest import PLAIN, corpus, prose

SF = "/root/testdata/sf0.01"


@given(st.lists(st.tuples(st.text("<|\\\nnlp", max_size=4), st.text("<|\\im_endstar>\né", max_size=30)), min_size=1, max_size=3))
@settings(max_examples=300, deadline=None)
def test_turns_come_back(turns):
    parsed = chat.parse("".join(chat.render(r, t) for r, t in turns))
    assert [p[:2] for p in parsed] == turns


def test_chat(spark):
    rows = [(1, 1, "assistant", "b<|im_end|>"), (1, 0, "user", None), (1, 1, "assistant", "a"), (2, None, None, "x" * 100_000),
            (None, 0, "assistant", "<\\|"), (2, None, None, "x" * 100_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, segment int")
    found = {r.conv_id: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert len(found) == 3
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert found[1].turns_sha256 == digest("user\n\nassistant\na\nassistant\nb<|im_end|>\n")
    assert found[1].loss_sha256 == digest("ab<|im_end|>") and found[1].loss_chars == 12
    assert found[None].loss_sha256 == digest("<\\|") and found[2].n_turns == 2 and found[2].loss_chars == 0
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_token_files(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_file())
    plain.encode_special_tokens = True
    path = str(tmp_path / "tokens")
    tokens.write_tokens(docs, path, queries.tokenizer_file())
    found = tokens.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    rows = sorted(corpus(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at = 0
    for row, got in zip(rows, found, strict=True):
        ids = plain.encode(row[1] or "", add_special_tokens=False).ids + [0]
        assert (got.doc_id, got.start, got.n_tokens, got.ids) == (row[0], at, len(ids), ids)
        assert got.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        at += len(ids)
    one = tokens.read_tokens(spark, path, F.array_contains("doc_ids", 12)).where("doc_id = 12").first()
    assert one.n_tokens == next(f.n_tokens for f in found if f.doc_id == 12)
    tokens.write_tokens(none, str(tmp_path / "none"), queries.tokenizer_file())
    assert tokens.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_encoder_against_the_library():
    own, pick = tokens.Encoder(queries.tokenizer_file()), random.Random(3)
    parts = ["a", "b.", "é", " ", "\n", "'s", "12", "\t", "…", "  ", "x,", "<|endoftext|>", "　", "文", "\x00", "Ab", "...", "\r\n", "ß!"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 25))) for _ in range(3000)]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_targets_against_the_rounds(spark):
    pick = random.Random(2)
    for n in (1, 2, 7, 30):
        sizes = {f"s{k:02d}" if k else None: pick.choice([0, 1, 10, 1000, 100_000]) for k in range(n)}
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        found = {r.source: r.target for r in mixing.source_targets(df).collect()}
        names = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: k % 3 + 1 for k, s in enumerate(names)}
        left, open_, want = float(sum(sizes.values())), set(names), {}
        while True:
            level = left / max(1, sum(weight[s] for s in open_))
            over = {s for s in open_ if weight[s] * level > 3 * sizes[s] + 1e-9}
            if not over:
                break
            for s in over:
                want[s] = 3.0 * sizes[s]
                left -= want[s]
            open_ -= over
        want |= {s: weight[s] * level for s in open_}
        assert found == pytest.approx(want)


def test_apportionment_against_highest_quotients(spark):
    pick = random.Random(5)
    for n, seats in ((1, 7), (5, 0), (5, 13), (40, 500)):
        votes = {k: pick.choice([0.0, 1.0, 5.5, 100.0, 9999.0]) for k in range(n)}
        df = spark.createDataFrame([(k, v, seats) for k, v in votes.items()], "party int, votes double, seats long")
        found = {r.party: r.quota for r in mixing.apportioned(df, [], "party", "votes", "seats").collect()}
        line = sorted((-v / (2 * j - 1), k, j) for k, v in votes.items() if v for j in range(1, seats + 1))[:seats]
        assert found == {k: sum(p == k for _, p, _ in line) for k in votes}


def test_mix(docs, none):
    rows = mixing.mix(docs, block_words=8, shard_docs=5).collect()
    assert len(rows) == len(corpus())
    taken, target = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert sum(target.values()) == pytest.approx(sum(r.size for r in rows))
    assert all(abs(taken[s] - target[s]) <= 40 for s in taken)
    again = mixing.mix(docs.repartition(7), block_words=8, shard_docs=5).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    mixed = mixing.mixture(docs, block_words=8, shard_docs=5)
    assert mixed.columns == docs.columns
    assert mixed.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(taken.values())
    assert mixing.mix(none).count() == 0 and mixing.mixture(none).count() == 0


def test_quality(spark, none):
    good, bad = [(k, prose(k % 40, 60)) for k in range(300)], [(1000 + k, "%%% ### " * 60) for k in range(100)]
    rows = [*good, *bad, (5000, None), (5001, ""), (None, prose(3, 60))]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], PLAIN)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(100)] + [(1000, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.resampled(df, quality.target_text(df, labels)).collect()}
    assert not kept & set(range(1000, 1100)) and len(kept & set(range(300))) > 290
    assert len(quality.resampled(df, quality.target_text(df, labels), k=7).collect()) == 7
    assert quality.resampled(df, df.limit(0)).count() == len(rows)
    assert quality.resampled(none, none).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_kth_highest(spark, seed):
    pick = random.Random(seed)
    values = [pick.choice([pick.randint(-(1 << 50), 1 << 50), 5]) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x long")
    for k in (1, 7, 150, 300):
        assert quality.kth_highest(df, "x", k) == sorted(values, reverse=True)[k - 1]


def test_language(spark, docs, none):
    rows = queries.QUERIES["op2_language_id"](spark, SF).join(queries.table(spark, SF, "documents"), "doc_id")
    held = rows.where("held_out and lang is not null").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.97
    found = language.predicted(docs, language.train(docs), "doc_id").collect()
    assert len(found) == len(corpus()) and all(0 <= r.score <= 1 for r in found)
    assert {r.lang_pred for r in found if r.doc_id in (5, 6, 7)} == {"und"}
    assert {r.lang_pred for r in language.predicted(docs, language.train(none), "doc_id").collect()} == {"und"}
    assert language.predicted(none, language.train(docs), "doc_id").count() == 0
    signs = spark.createDataFrame([(1, "½ ² ③ Ⅷ _ 7"), (2, "½ é")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred == "und" for r in language.predicted(signs, language.train(docs), "doc_id").collect()} == {1: True, 2: False}


def test_toxicity(spark, docs, none):
    larger = "/root/testdata/sf0.1"  # the smaller tables hold about 30 toxic rows to learn from
    rows = queries.QUERIES["op3_toxicity"](spark, larger).join(queries.table(spark, larger, "labels"), "doc_id").where("held_out")
    rows = rows.collect()
    clean = [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in clean) <= len(clean) // 50
    assert sum(r.predicted for r in rows if r.toxic) >= 0.7 * sum(r.toxic for r in rows)
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.scored(docs, labels).collect()} == {1.0}
    assert {r.score for r in toxicity.scored(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.scored(none, labels).count() == 0


def test_pipeline(spark):
    docs = queries.table(spark, SF, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = quality.saved(stage(spark, docs, SF), "stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
        kept[name] = docs.count()
    assert docs.count() == kept["mixing sources to target weights"] > 0
    assert kept["n-gram Jaccard join"] < kept["quality classifier"] < 1000


def test_pipeline_of_odd_rows(spark):
    docs = spark.createDataFrame([r[:5] for r in corpus()], PLAIN)
    for name, stage in corpus_pipeline.STAGES:
        docs = quality.saved(stage(spark, docs, SF), "stage")
    assert docs.count() > 0
    empty = spark.createDataFrame([], PLAIN)
    for name, stage in corpus_pipeline.STAGES:
        empty = quality.saved(stage(spark, empty, SF), "stage")
    assert empty.count() == 0


def test_new_words_are_encoded_many_in_a_call():
    """Words of letters go to the merges and others to the tokenizer in bulk, with the ids that each text has by itself."""
    encoder = tokens.Encoder(queries.tokenizer_file())
    words = prose(91, 600).split(" ")
    ends = ["", ".", ",", "!!", "à", "é,", "ß;", "7", "文", "&&&", "...", "'s", "Ġ", "<|endoftext|>", "İ", "​"]
    texts = [" ".join(w + ends[(k + n) % len(ends)] for n, w in enumerate(words[k:k + 40])) + "\n" + words[k] + ends[k % len(ends)]
             for k in range(500)]
    texts += ["", "à à", "x\ny", "x \n y", " x", "x y à ", "x\x00y", "\n", "x\x1cy"]
    calls = []
    plain, merge = encoder.plain, encoder.merge
    encoder.plain = lambda own: calls.append(len(own)) or plain(own)
    encoder.merge = lambda own: calls.append(1) or merge(own)
    for _ in range(2):
        assert [ids.tolist() for ids in encoder.encode(texts)] == plain(texts)
    assert len(calls) < len(encoder.known) / 10


def test_encoder_keeps_few_words():
    encoder = tokens.Encoder(queries.tokenizer_file(), most=100)
    texts = [" ".join(f"word{k}x{i}" for i in range(60)) + " the end." for k in range(20)]
    for text in texts:
        assert [ids.tolist() for ids in encoder.encode([text])] == encoder.plain([text])
        assert len(encoder.known) <= 100 + 62


def test_freed_memory_goes_back_at_the_end_of_a_task():
    def held() -> int:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096 >> 20

    def step(batches):
        for batch in batches:
            parts = [bytes(b"x" * 100_000) for _ in range(2000)]
            pins.append(bytes(100_000))
            yield batch
            del parts

    pins: list[bytes] = []
    batch = pa.RecordBatch.from_pydict({"n": [1]})
    before = held()
    assert list(store.frugal(step)(iter([batch]))) == [batch]
    assert held() - before < 60
    early = store.frugal(step)(iter([batch, batch]))
    assert next(early) == batch
    early.close()
    assert held() - before < 60
