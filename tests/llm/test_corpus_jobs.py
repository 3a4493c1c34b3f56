"""Operators over a whole corpus: sharding, decontamination, token files,
language ID, line dedup, mixing and the pipeline."""

from __future__ import annotations

import io
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from emporium.llm import hot as HOT
from emporium.llm import decontamination as D
from emporium.llm import language_id as LI
from emporium.llm import line_dedup as LD
from emporium.llm import mixing as M
from emporium.llm import registry
from emporium.llm import sharding as S
from emporium.llm import token_files as TF
from emporium.llm.graph import components
from emporium.session import scratch_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0),
       (None, "Some words here\nand there", "en", None, 5), (None, None, None, None, None),
       (3, "long " * 40_000, "en", "s", 1)]


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---------------------------------------------------------------- sharding
def check_shards(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(i, ())) for i in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_sharding(spark):
    docs = docs_of(spark)
    rows = S.shard(docs, bucket_bytes=20_000).collect()  # many buckets
    check_shards(rows, S.SHARDS)
    assert sorted(tuple(r)[:5] for r in rows) == sorted(map(tuple, docs.collect()))
    assert [r.doc_id for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))] \
        != sorted(r.doc_id for r in rows)
    again = S.shard(docs, bucket_bytes=20_000).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_sharding_odd_rows(spark):
    docs = spark.createDataFrame(ODD + [ODD[1]] * 200, SCHEMA)
    check_shards(S.shard(docs).collect(), S.SHARDS)
    few = spark.createDataFrame(ODD[:3], SCHEMA).selectExpr("*", "7 AS slot", "'x' AS shard")
    rows = S.shard(few)
    assert rows.columns == [*SCHEMA.replace(",", "").split()[::2], "shard", "slot"]
    check_shards(rows.collect(), S.SHARDS)
    assert S.shard(docs.where("false")).collect() == []
    digest = {r.doc_id: r for r in S.digest(docs_of(spark)).collect()}
    for r in docs_of(spark).collect():
        data = r.text.encode()
        assert (digest[r.doc_id].size, digest[r.doc_id].text_crc32) == (len(data) + 16, zlib.crc32(data))


def test_written_shards(spark, tmp_dir):
    S.write_shards(docs_of(spark), f"{tmp_dir}/shards", shards=7)
    rows = spark.read.parquet(f"{tmp_dir}/shards").collect()
    check_shards(rows, 7)
    assert len(rows) == docs_of(spark).count()


# ---------------------------------------------------------------- decontamination
def brute_matches(texts, items, least=D.LEAST_SIMILARITY):
    found = {}
    for doc, text in texts.items():
        words = D.words_of(text)
        for item, passage in items.items():
            own = D.words_of(passage)
            n = min(D.SHINGLE, len(own))
            for k in range(len(words) - len(own) + 1 if own else 0):
                a = Counter(zip(*(words[k + i:k + len(own)] for i in range(n))))
                b = Counter(zip(*(own[i:] for i in range(n))))
                shared = sum((a & b).values())
                if shared:
                    sim = shared / sum((a | b).values())
                    if sim >= least and sim > found.get((doc, item), (0,))[0]:
                        found[doc, item] = (sim, k)
    return found


def planted(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    items = {i: " ".join(rng.choice(words) for _ in range(n))
             for i, n in enumerate((3, 5, 8, 30, 30, 41, 60))}
    items[7] = items[3].upper().replace(" ", ",  ")  # the same words
    texts = {}
    for doc in range(60):
        body = [rng.choice(words) for _ in range(rng.randint(0, 150))]
        if doc % 3:
            own = items[rng.randrange(7)].split()
            for _ in range(doc % 4 if len(own) > 20 else 0):  # near copies
                own[rng.randrange(len(own))] = "edited"
            at = rng.randint(0, len(body))
            body[at:at] = own
        texts[doc] = " ".join(body)
    return texts, items


def test_decontamination_matches_brute_force(spark):
    texts, items = planted(spark)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    table = spark.createDataFrame([*items.items(), (None, None), (99, "")],
                                  "item_id long, text string")
    want = brute_matches(texts, items)
    assert any(0 < sim < 1 for sim, _ in want.values())
    for chunk_bytes in (D.CHUNK_BYTES, 200):  # in one pass and in several
        got = {(r.doc_id, r.item_id): (r.similarity, r.start_word)
               for r in D.matches(docs, table, chunk_bytes=chunk_bytes).collect()}
        assert got == want
        clean = D.keep_clean(docs, table, chunk_bytes=chunk_bytes)
        plan = clean._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1  # one item index a task, however many passes
        kept = {r.doc_id for r in clean.collect()}
        assert kept == set(texts) - {doc for doc, _ in want}


def brute_short(texts, items, least=D.LEAST_SIMILARITY):
    """Similarity of the best window of min(item, document) words."""
    found = {}
    for doc, text in texts.items():
        words = D.words_of(text)
        for item, passage in items.items():
            own = D.words_of(passage)
            n, size = min(D.SHINGLE, len(own)), min(len(own), len(words))
            for k in range(len(words) - size + 1 if size >= n else 0):
                a = Counter(zip(*(words[k + i:k + size] for i in range(n))))
                b = Counter(zip(*(own[i:] for i in range(n))))
                sim = sum((a & b).values()) / sum((a | b).values())
                if sim >= least and sim > found.get((doc, item), (0,))[0]:
                    found[doc, item] = (sim, k, size)
    return found


def test_decontamination_of_documents_shorter_than_the_item(spark):
    rng = random.Random(11)
    items = {i: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 + str(rng.randrange(300))
                         for _ in range(n)) for i, n in enumerate((3, 5, 9, 20, 60, 60, 150))}
    texts = {}
    for item in items.values():
        own = item.split()
        for lost in range(len(own) // 4 + 3):  # cut at the end, at the start, inside
            at = rng.randrange(len(own))
            for kept in (own[:len(own) - lost], own[lost:], own[:at] + own[at + lost:]):
                texts[len(texts)] = " ".join(kept)
    want = brute_short(texts, items)
    assert any(size < len(items[i].split()) for (_, i), (_, _, size) in want.items())
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word, r.n_words)
           for r in D.matches(docs, table).collect()}
    assert got == want
    assert {r.doc_id for r in D.keep_clean(docs, table).collect()} == set(texts) - {d for d, _ in want}


def test_hamming_index_finds_all_in_radius():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    queries = []
    for f in items.tolist():
        for bits in range(0, 26, 3):
            queries.append(f ^ sum(1 << b for b in random.Random(bits).sample(range(64), bits)))
    queries = np.array(queries, dtype=np.uint64)
    q, i, d = D.HammingIndex(items).within(queries)
    got = set(zip(q.tolist(), i.tolist(), d.tolist()))
    want = {(a, b, (int(x) ^ int(y)).bit_count()) for a, x in enumerate(queries)
            for b, y in enumerate(items) if (int(x) ^ int(y)).bit_count() <= D.RADIUS}
    assert got == want


def test_decontamination_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    table = spark.createDataFrame([(1, "words here and")], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.start_word) for r in D.matches(docs, table).collect()] \
        == [(None, 1, 1)]
    assert D.keep_clean(docs, table).count() == len(ODD) - 1
    assert D.matches(docs, table.where("false")).collect() == []
    assert D.keep_clean(docs, table.where("false")).count() == len(ODD)
    assert D.matches(docs.where("false"), table).collect() == []


# ---------------------------------------------------------------- token files
@settings(max_examples=120, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)),
                max_size=400))
def test_blocks_round_trip(ids):
    ids = np.array(ids, dtype=np.uint64)
    assert np.array_equal(TF.decode_block(TF.encode_block(ids)), ids)


def test_blocks_are_packed():
    ids = np.zeros(6_000, dtype=np.uint64)
    assert len(TF.encode_block(ids)) == 16 + 8 * 100
    assert len(TF.encode_block(ids + np.uint64(20_000))) == 16 + 8 * 1_500


def test_file_round_trip():
    rng = np.random.default_rng(2)
    docs = [(None, rng.integers(0, 50_000, n).astype("<u4")) for n in (1, 5)] + \
        [(i, rng.integers(0, 50_000, n).astype("<u4")) for i, n in enumerate((3, 200_000, 1, 70_000))]
    sink = io.BytesIO()
    writer = TF.Writer(sink)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())
    reader = TF.Reader(Source(sink.getvalue()))
    starts = np.cumsum([0] + [len(ids) for _, ids in docs])
    assert list(reader.documents()) == [
        (doc_id, int(s), len(ids), zlib.crc32(ids.tobytes())) for (doc_id, ids), s in zip(docs, starts)]
    for k in (0, 3, 5):
        assert np.array_equal(reader.document(k), docs[k][1])


def tokens(text, tokenizer=[]):
    if not tokenizer:
        import tokenizers
        tokenizer.append(tokenizers.Tokenizer.from_file(TF.default_tokenizer()))
        tokenizer[0].encode_special_tokens = True
    return tokenizer[0].encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1'é .,\n\t 　\x1cs", max_size=40))
def test_cached_tokenizer_is_exact(text):
    if not CACHED:
        CACHED.append(TF.CachedTokenizer(open(TF.default_tokenizer()).read()))
    assert CACHED[0].ids(text).tolist() == tokens(text)


CACHED: list = []


ADDED = ["end <|endoftext|> next", "<|endoftext|> at the start", "<|endoftext|>", "a<|endoftext|>b",
         "two  <|endoftext|>  spaces \n<|endoftext|>\n", "x <|endoftext|><|endoftext|>.", "<|endoftext| >",
         "long " * 5_000 + "<|endoftext|>" + " text" * 5_000]


def test_long_pieces_are_exact_and_not_kept():
    with open(TF.default_tokenizer(), encoding="utf-8") as f:
        tokenizer = TF.CachedTokenizer(f.read())
    for piece in ("a" * 5_000, "Zm9vYmFy" * 900 + ".", "漢字" * 2_000, "x" * TF.LONGEST_KEPT + "!"):
        text = f"so {piece} and {piece}, {piece}"
        assert tokenizer.ids(text).tolist() == tokens(text)
    assert max(map(len, tokenizer.pieces)) <= TF.LONGEST_KEPT


def test_token_folder_names_its_file_system(spark, tmp_path):
    assert TF._qualified(spark, str(tmp_path)).startswith("file:/")
    assert TF._qualified(spark, f"file:{tmp_path}") == TF._qualified(spark, str(tmp_path))
    store, root = TF._store(TF._qualified(spark, str(tmp_path)))
    assert store.type_name == "local" and root == str(tmp_path)


def test_added_tokens_have_their_own_id(spark):
    import tokenizers
    plain = tokenizers.Tokenizer.from_file(TF.default_tokenizer())
    cached = TF.CachedTokenizer(open(TF.default_tokenizer()).read())
    want = [plain.encode(t, add_special_tokens=False).ids + [0] for t in ADDED]
    assert want[0] == [437, 220, 50256, 1306, 0]
    assert [cached.ids(t).tolist() for t in ADDED] == want
    rows = TF.digest(spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")).collect()
    starts = np.cumsum([0, *map(len, want)])
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == [
        (k, starts[k], len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        for k, ids in enumerate(want)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|", " ", "  ", "\n", "a", "é.", "'s"]), max_size=12))
def test_added_tokens_random(parts):
    import tokenizers
    if not PLAIN:
        PLAIN.append((tokenizers.Tokenizer.from_file(TF.default_tokenizer()),
                      TF.CachedTokenizer(open(TF.default_tokenizer()).read())))
    plain, cached = PLAIN[0]
    text = "".join(parts)
    assert cached.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids + [0]


PLAIN: list = []


def check_tokens(rows, texts):
    """``texts``: (doc_id, text) in file order."""
    start, want = 0, []
    for doc_id, text in texts:
        ids = np.array(tokens(text), dtype="<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want


def test_new_words_skip_the_library_pipeline():
    """Words not seen before, with marks and line ends, go to the model alone."""
    cached = TF.CachedTokenizer(open(TF.default_tokenizer()).read())
    words = [f"{a}{b}{c}" for a in ("Stra\u00dfen", "qui", "X") for b in "bcdfg" for c in ("\u00e9t", "ok", "ZZ")]
    text = " ".join(f"{w}{mark}\n{w[::-1]}{mark}" for w in words for mark in ("", ".", "***", ",!?"))
    want = cached.tokenizer.encode(text, add_special_tokens=False).ids
    calls = []
    plain = cached.tokenizer
    cached.tokenizer = type("Counted", (), {
        "encode": lambda self, t, **k: calls.append(t) or plain.encode(t, **k)})()
    assert cached.ids(text)[:-1].tolist() == want
    assert set(calls) == {"\n", ".", "***", ",!?"} and len(calls) == 4


def test_odd_parts_equal_the_plain_call():
    """What looks like a letter or a mark, but joins other pre-tokens, is encoded whole."""
    cached = TF.CachedTokenizer(open(TF.default_tokenizer()).read())
    parts = ["a'll.", "a.'s", "x\u00d7y", "x\u00f7.", "\u00bd.", "\u00aa\u00ba\u00b5", "\u4e2d\u6587.", "\u05e9\u05b0.",
             "e\u0301!", "a\r\nb", "a\n\nb", "\na", "a\n", "\u0120a", "1a.", "...", "a_b", "\u200ba", "\u01c5."]
    for a in parts:
        for b in ("", *parts):
            for text in (f"{a} {b}", f"{a}{b}", f"{a}\n{b}", f" {a}  {b} "):
                want = cached.tokenizer.encode(text, add_special_tokens=False).ids
                assert cached.ids(text)[:-1].tolist() == want, text


def test_token_files(spark):
    docs = docs_of(spark)
    check_tokens(TF.digest(docs).collect(), sorted((r.doc_id, r.text) for r in docs.collect()))
    odd = spark.createDataFrame(ODD[1:4] + ODD[5:], SCHEMA)
    check_tokens(TF.digest(odd).collect(),
                 [(None, ODD[3][1]), (2, ""), (2, ""), (3, ODD[5][1])])
    assert TF.digest(odd.where("false")).collect() == []


# ---------------------------------------------------------------- language ID
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = LI.identify(docs)
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def brute_scores(model, text):
    """Posterior by a plain loop over the same hashed n-grams."""
    codes = LI._codes(text)
    total = np.zeros(len(model.languages))
    for buckets in LI._grams(codes):
        for b in buckets.tolist():
            total += model.log_probability[:, b]
    p = np.exp(total - total.max())
    return model.languages[int(total.argmax())], float(p.max() / p.sum())


def test_batch_scores_match_a_plain_loop(spark, monkeypatch):
    docs = docs_of(spark)
    model = LI.train(LI.training_sample(docs))
    unlettered = [None, "", "123 !!", "½ 3/4", "²", "Ⅷ _", "٣", "一"[:0], "\U0001f600"]
    texts = [r.text[:300] for r in docs.limit(40).collect()] + unlettered + ["x", "é", "a b", "½a", "ª", "一", "ʰ"]
    monkeypatch.setattr(LI, "PIECE", 64)  # many pieces and blocks
    names, scores = model.score(texts)
    for text, name, score in zip(texts, names, scores):
        if text in unlettered:
            assert (name, score) == ("und", 0.0)
        else:
            want, p = brute_scores(model, text)
            assert name == want and score == pytest.approx(p, rel=1e-6)


def test_training_rows_are_read_in_as_many_tasks_as_the_table_has(spark):
    rows = spark.range(0, 400, 1, 40).selectExpr(
        "concat('l', spark_partition_id()) AS lang", "concat('some words ', id) AS text")
    assert len(LI.train(rows, tasks=3).languages) == 40  # a language a reading task


def test_language_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    rows = LI.identify(docs).collect()
    assert len(rows) == len(ODD)
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (1, 2))
    assert LI.identify(docs.where("false")).collect() == []
    unlabelled = docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {r.lang_pred for r in LI.identify(unlabelled).collect()} == {"und"}
    model = LI.train(LI.training_sample(docs_of(spark)))
    kept = LI.keep_identified(docs.withColumnRenamed("n_chars", "lang_pred"), model)
    assert kept.columns[-1] == "lang_pred" and 1 <= kept.count() <= 2


# ---------------------------------------------------------------- line dedup
def brute_removed(texts):
    """doc → removed line positions, over exact Jaccard links of all lines."""
    norm = {}
    for doc in sorted(texts):
        for k, line in enumerate((texts[doc] or "").split("\n")):
            line = re.sub(r"\s+", " ", line).strip(" ").lower()
            if line:
                norm[doc, k] = line
    lines = sorted(set(norm.values()))
    sets = [LD.shingles(x) for x in lines]
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(lines)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and shared >= 0.8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    group = {line: find(i) for i, line in enumerate(lines)}
    seen, removed = set(), defaultdict(list)
    for (doc, k), line in sorted(norm.items()):
        if group[line] in seen:
            removed[doc].append(k)
        seen.add(group[line])
    return removed


def line_texts():
    rng = random.Random(11)
    letters = "abcdefghijklmnop "
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 90))) for _ in range(25)]
    texts = {}
    for doc in range(40):
        own = []
        for _ in range(rng.randint(1, 8)):
            line = rng.choice(base) if rng.random() < 0.6 else \
                "".join(rng.choice(letters) for _ in range(60))
            if rng.random() < 0.4 and len(line) > 30:  # a near copy, sometimes too far
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice(("X", "", "quite another")) + line[at + 1:]
            own.append(rng.choice((line, line, f"  {line.upper()}\t ", "", "  ")))
        texts[doc] = "\n".join(own)
    return texts


@pytest.mark.parametrize("chunk, far_chunks", [(LD.CHUNK_LINES, LD.FAR_CHUNKS), (2, 10_000), (2, 0)])
def test_line_dedup_matches_brute_force(spark, monkeypatch, chunk, far_chunks):
    monkeypatch.setattr(LD, "CHUNK_LINES", chunk)
    monkeypatch.setattr(LD, "FAR_CHUNKS", far_chunks)
    texts = line_texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_removed(texts)
    assert sum(map(len, want.values())) > 20
    got = {r.doc_id: r.removed for r in LD.digest(docs).collect()}
    assert got == {doc: want.get(doc, []) for doc in texts}


@pytest.mark.parametrize("far_chunks", [LD.FAR_CHUNKS, 0])
def test_line_dedup_of_a_large_family(spark, monkeypatch, far_chunks):
    """Two families that meet in bands, many chunks: near lines of one pivot
    do not meet, far ones meet everything."""
    monkeypatch.setattr(LD, "CHUNK_LINES", 5)
    monkeypatch.setattr(LD, "FAR_CHUNKS", far_chunks)
    rng = random.Random(3)
    stem = "".join(rng.choice("abcdefghijklmnop ") for _ in range(120))
    other = stem[:60] + "".join(rng.choice("qrstuvwxyz") for _ in range(60))
    family = [f"{stem}{k:03d}" for k in range(60)] + [f"{other}{k:03d}" for k in range(30)]
    family += [stem[:100 + k] for k in range(0, 20, 2)] + [stem[30:], stem[:60], stem[:75]]
    texts = {k: f"{line}\nown line {k} {rng.random()}" for k, line in enumerate(family)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_removed(texts)
    got = {r.doc_id: r.removed for r in LD.digest(docs).collect()}
    assert got == {doc: want.get(doc, []) for doc in texts}


def test_line_dedup_of_lines_with_a_common_start(spark, monkeypatch):
    """Log lines that share a long start without being similar: the rows that
    meet grow with the lines, not with their square, and the few links in the
    crowd, also of lines far from every pivot, are found."""
    linked, rows = LD._linked, []

    def counted(members, wanted, lines):
        rows.append(members.count())
        return linked(members, wanted, lines)
    monkeypatch.setattr(LD, "_linked", counted)
    monkeypatch.setattr(LD, "CHUNK_LINES", 64)
    monkeypatch.setattr(LD, "FAR_CHUNKS", 2)
    rng = random.Random(17)
    start = "".join(rng.choice("abcdefghijklmnop ") for _ in range(99)) + "x"
    met = {}
    for n in (1_200, 4_800):
        ends = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40)) for _ in range(n)]
        lines = [start + e for e in ends]
        copies = {k: lines[k][:-3] + "###" for k in range(0, n, 100)}
        texts = dict(enumerate(lines)) | {n + k: line for k, line in copies.items()}
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        rows.clear()
        got = {r.doc_id: r.removed for r in LD.removed_lines(docs).collect()}
        assert got == {n + k: [0] for k in copies}
        met[n] = sum(rows)
    assert met[4_800] < 5 * met[1_200]


def test_similar_lines_share_a_shingle_of_their_prefixes():
    rng = random.Random(23)
    checked = 0
    for _ in range(3_000):
        a = "".join(rng.choice("abcdef ") for _ in range(rng.randint(1, 150)))
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            b[rng.randrange(len(b))] = rng.choice("xyz")
        b = "".join(b)[rng.randint(0, 3):] or a
        x, y = LD.shingles(a), LD.shingles(b)
        if len(x & y) >= 0.8 * len(x | y):
            checked += 1
            counts = np.array([rng.randint(0, 3) for _ in range(64)])
            assert set(LD.prefix(LD.shingle_hashes(a), counts)) & set(LD.prefix(LD.shingle_hashes(b), counts))
            assert len(LD.shingle_hashes(a)) == len(x)
    assert checked > 500


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(HOT, "MOST_HOT_KEYS", 10)
    rng = random.Random(5)
    edges = [(0, k) for k in range(1, 200)] + [(900, k) for k in range(300, 500)]
    edges += [(k, k + 1) for k in range(1000, 1030)] + [(5, 300), (2000, 2000)]
    edges += [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(150)]
    rng.shuffle(edges)
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(root[a], root[b])
            if root[a] != least or root[b] != least:
                root[a] = root[b] = least
                changed = True
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {(r.node, r.root) for r in got.collect()} == {(x, root[x]) for x in linked}


def test_lone_white_space_of_any_kind_is_one_space(spark):
    lines = [" a b  c ", *(f"A{c}b c{c}" for c in "\t\r\f\v"), "a \r\n b c".replace("\n", "")]
    docs = spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "doc_id long, text string")
    assert {r.line for r in LD._lines(docs, "doc_id", "text").select("line").collect()} == {"a b c"}
    assert {r.doc_id: r.removed for r in LD.removed_lines(docs).collect()} \
        == {k: [0] for k in range(1, len(lines))}


def test_bands_miss_few_links_at_the_threshold():
    assert (1 - LD.LEAST_SIMILARITY ** LD.ROWS) ** LD.BANDS < 2.3e-4
    assert LD.band_hashes(["a line", "another line"]).shape == (2, LD.BANDS)


def test_band_hashes_of_pieces(monkeypatch):
    lines = ["short", "x" * 8, "the quick brown fox jumps over it " * 9, "é" * 50, "ab"]
    whole = LD.band_hashes(lines)
    monkeypatch.setattr(LD, "PIECE", 16)
    assert np.array_equal(LD.band_hashes(lines), whole)
    assert np.array_equal(LD.band_hashes(lines[2:3]), whole[2:3])


def test_only_bands_of_several_lines_become_rows(spark, monkeypatch):
    """Bands travel as arrays, so that no row is shuffled for each band of each line."""
    monkeypatch.setattr(LD, "BUCKET_KEYS", 256)
    lines = [f"line {k % 40} of some text that is long enough, {k // 40 * 'x'}" for k in range(120)] + ["a", "\u00e9" * 300]
    df = spark.createDataFrame([(k, line, 1 << len(line).bit_length()) for k, line in enumerate(lines)],
                               "line_id long, line string, chars long")
    held = {}
    for k, keys in enumerate(LD.band_hashes(lines).tolist()):
        for key in keys:
            held.setdefault(key, []).append(k)
    want = sorted((key, k, 1 << len(lines[k]).bit_length()) for key, ks in held.items() if len(ks) > 1 for k in ks)
    found = LD._repeated_bands(df)
    assert want and sorted(map(tuple, found.collect())) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [bucket" in plan and "explode" not in plan


def test_rows_seen_again_in_later_batches():
    seen = LD.Once()
    batches = [([5, 3, 5], [1, 2, 3]), ([9, 3], [4, 5]), ([3, 9, 7], [6, 7, 8])]
    out = [seen.repeated(np.array(k), np.array(i), np.array(i) * 2) for k, i in batches]
    assert [sorted(zip(o["key"], o["line_id"], o["chars"])) for o in out] == [
        [(5, 1, 2), (5, 3, 6)], [(3, 2, 4), (3, 5, 10)], [(3, 6, 12), (9, 4, 8), (9, 7, 14)]]


def test_two_lines_are_compared_alike_by_sets_and_matrix(monkeypatch):
    import random
    random.seed(3)
    for _ in range(300):
        base = "".join(random.choices("ab \u00e9\u4e2d", k=random.randint(1, 90)))
        other = base[:random.randint(0, 90)] + "b" * random.randint(0, 3) + base[random.randint(0, 90):]
        monkeypatch.setattr(LD, "SHORT", 1 << 11)
        sets = LD.unit_links([base, other])
        monkeypatch.setattr(LD, "SHORT", 0)
        assert LD.unit_links([base, other]) == sets


def test_pairs_compared_together_equal_pairs_by_themselves(monkeypatch):
    rng = random.Random(29)
    pairs = [("", ""), ("a", "a"), ("a", "b"), ("x" * 9, "x" * 3_000), ("ab" * 1_500, "ab" * 1_400)]
    for _ in range(3_000):
        letters = rng.choice(("ab", "ab \u00e9\u00ff", "abcdefghij ", "ab\u0100\u4e2d"))
        base = "".join(rng.choices(letters, k=rng.randint(1, 90)))
        other = base[:rng.randint(0, 90)] + "b" * rng.randint(0, 3) + base[rng.randint(0, 90):]
        pairs.append((base, other) if rng.random() < 0.5 else (base, base[:-1] + "a" + rng.choice(("", "a"))))
    want = [bool(LD.unit_links(list(p))) for p in pairs]
    assert 500 < sum(want) < 2_500
    assert LD.pairs_linked(pairs).tolist() == want
    monkeypatch.setattr(LD, "PIECE", 64)
    assert LD.pairs_linked(pairs).tolist() == want
    assert LD.pairs_linked([]).tolist() == []


def test_units_go_on_in_the_next_batch():
    rng = random.Random(31)
    stem = "".join(rng.choices("abcdefgh ", k=60))
    rows = [(unit, unit * 7, 2, 10 * unit + k, stem + str(k) if k < 3 else f"far {k} {rng.random()}")
            for unit in range(40) for k in range(rng.choice((1, 2, 2, 3, 5)))]

    def links(size):
        names = ["unit", "same", "n", "line_id", "line"]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[at:at + size])], names)
                   for at in range(0, len(rows), size)]
        return sorted(tuple(r.values()) for b in LD._links_in_units(iter(batches)) for r in b.to_pylist())
    want = sorted((u * 7, 2, i, 10 * u) for u, _, _, i, _ in rows if i % 10 in (1, 2))
    assert [links(size) for size in (1, 2, 7, 1_000)] == [want] * 4
    assert [b.num_rows for b in LD._links_in_units(iter([]))] == [0]


@pytest.mark.parametrize("keys, records", [(16, 7), (64, 3), (1 << 18, 10)])
def test_bands_of_buckets_in_many_batches(spark, monkeypatch, keys, records):
    monkeypatch.setattr(LD, "BUCKET_KEYS", keys)
    lines = [f"line {k % 9} of some text, {k // 9 % 4 * 'x'}" for k in range(150)]
    df = spark.createDataFrame([(k << 30, line, 64) for k, line in enumerate(lines)],
                               "line_id long, line string, chars long")
    held = {}
    for k, own in enumerate(LD.band_hashes(lines).tolist()):
        for key in own:
            held.setdefault(key, []).append(k)
    want = sorted((key, k << 30, 64) for key, ks in held.items() if len(ks) > 1 for k in ks)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    try:
        assert sorted(map(tuple, LD._repeated_bands(df).collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bands_of_both_orders_hold_as_many_links_as_independent_ones():
    """An order gives two minima, its smallest and largest: half the products, the same odds."""
    assert len(LD._FACTORS) == LD.BANDS * LD.ROWS // 2
    rng = random.Random(37)
    for size in (20, 100):
        a = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=size)) for _ in range(4_000)]
        b = [line[rng.randint(1, size // 10):] for line in a]
        sets = [(LD.shingles(x), LD.shingles(y)) for x, y in zip(a, b)]
        odds = np.array([len(x & y) / len(x | y) for x, y in sets]) ** LD.ROWS
        held = LD.band_hashes(a) == LD.band_hashes(b)
        assert abs(held.mean() - odds.mean()) < 0.01
        assert (~held.any(axis=1)).mean() < ((1 - odds) ** LD.BANDS).mean() + 0.003


def test_lines_of_documents_are_looked_up_as_they_stand(spark):
    """Only different lines are brought to their normal form, not all lines again."""
    lines = ["Some line that is long", "some LINE that is long ", "Some line\tthat is  long", "\u00c9t\u00e9",
             "\u00e9t\u00e9", "Some line that is long", "a", "A", "other"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    removed = LD.removed_lines(docs)
    assert "lower(" not in removed._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.doc_id for r in removed.collect()) == [1, 2, 4, 5, 7]


def test_number_of_lines_counts_line_ends(spark):
    texts = [None, "", "a", "a\n", "\n\n", "a\n\u00e9\nb", "a\r\nb"]
    rows = LD.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_lines for r in rows} == {k: 0 if t is None else t.count("\n") + 1 for k, t in enumerate(texts)}


def test_line_dedup_texts_and_odd_rows(spark):
    rows = [*ODD, (10, "One line that is long enough\n\n\nand another line, also long\nOne line that "
                   "is long enough", "x", "y", 1),
            (11, "and ANOTHER line, also  long \nkept", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("n_chars", "removed")
    out = LD.dedup_lines(docs)
    assert out.columns == docs.columns
    texts = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    want = [(r[0], r[1]) for r in rows[:6]]
    want += [(10, "One line that is long enough\n\n\nand another line, also long"), (11, "kept")]
    assert texts == sorted(want, key=repr)
    assert LD.digest(docs.where("false")).collect() == []


# ---------------------------------------------------------------- mixing
def water_fill(sizes, weights):
    """Targets by resharing the excess until no source is above its bound."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, stopped, left = {}, set(), sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in stopped]
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * sizes[s]}
        for s in open_:
            target[s] = left * weight[s] / total
        if not over:
            return target
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        stopped |= over


@pytest.mark.parametrize("seed", range(3))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice((0, 1, 10, 100, 5_000)) + rng.randint(1, 9) for s in "abcdefg"} | {None: 40}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in M.source_targets(rows).collect()}
    assert got == pytest.approx(water_fill(sizes, M.WEIGHTS))


def assert_near_targets(rows, source_of):
    """Each source's taken words are its target, up to its largest document."""
    by_source = defaultdict(list)
    for r in rows:
        by_source[source_of[r.id]].append(r)
    for part in by_source.values():
        taken = sum(r.copies * r.size for r in part)
        assert abs(taken - part[0].target) <= max(r.size for r in part), (taken, part[0].target)


def test_mix_of_unequal_documents(spark):
    """Few documents a source, of sizes from one word to thousands."""
    rng = random.Random(2)
    rows = [(i, "w " * int(rng.paretovariate(0.6)) , "en", f"s{i % 7}", 0) for i in range(350)]
    docs = spark.createDataFrame([(i, t[:20_000], *rest) for i, t, *rest in rows], SCHEMA)
    for seed in ("a", "b", "c"):
        assert_near_targets(M.mixed(docs, seed=seed).collect(), {r[0]: r[3] for r in rows})


def test_null_ids_are_drawn_apart(spark):
    docs = spark.createDataFrame([(None, f"some words {i} " * 10, "en", s, 0) for i in range(200) for s in "abc"], SCHEMA)
    copies = {(r.doc.source, r.copies) for r in M.mixed(docs).collect()}
    assert len(copies) > 3  # some source has documents taken differently


def test_mix(spark):
    docs = docs_of(spark)
    part = {r.id: r for r in M.mixed(docs).collect()}
    copies = Counter(r.doc_id for r in M.mix(docs).collect())
    assert copies == Counter({i: r.copies for i, r in part.items() if r.copies})
    for r in part.values():
        rate = r.target / r.source_size
        assert int(rate) <= r.copies <= min(3, int(rate) + 1)
    assert_near_targets(part.values(), {r.doc_id: r.source for r in docs.collect()})
    assert M.mix(docs).columns == docs.columns
    assert sorted(M.digest(docs).collect()) == sorted(M.digest(docs).collect())


def test_mix_without_broadcast(spark, monkeypatch):
    docs = docs_of(spark)
    want = sorted(M.digest(docs).collect())
    monkeypatch.setattr(M, "BROADCAST_ROWS", 0)
    assert sorted(M.digest(docs).collect()) == want


def test_mix_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA).withColumnRenamed("n_chars", "copies")
    rows = M.digest(docs).collect()
    assert len(rows) == len(ODD) and all(0 <= r.taken <= 3 * r.size for r in rows)
    nothing = M.digest(docs.where("doc_id <= 2")).collect()
    assert {(r.size, r.target, r.taken) for r in nothing} == {(0, 0.0, 0)}
    assert M.mix(docs).columns == docs.columns
    assert M.digest(docs.where("false")).collect() == []


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    docs = docs_of(spark)
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, made[-1], SF).write.parquet(path)
        made.append(spark.read.parquet(path))
    read, known, single, clean, mix, shards = [d.collect() for d in made]
    assert all(d.columns == docs.columns for d in made[:-1])
    assert {r.doc_id for r in read} == {r.doc_id for r in known}  # all documents have letters
    from test_simhash_dedup import brute_fp, brute_groups
    groups = brute_groups({r.doc_id: brute_fp(r.text) for r in known})
    assert sorted(r.doc_id for r in single) == sorted(set(groups.values()))
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    leaks = {doc for doc, _ in brute_matches({r.doc_id: r.text for r in single}, items)}
    assert leaks and {r.doc_id for r in clean} == {r.doc_id for r in single} - leaks
    part = {r.id: r.copies for r in M.mixed(made[3]).collect()}
    assert Counter(r.doc_id for r in mix) == Counter({i: n for i, n in part.items() if n})
    check_shards(shards, S.SHARDS)
    assert sorted(tuple(r)[:5] for r in shards) == sorted(map(tuple, mix))


def test_pipeline_odd_rows(spark):
    docs = spark.createDataFrame(ODD + [(8, "ein Satz", "de", "s", 1)], SCHEMA) \
        .selectExpr("*", "1 AS shard", "'q' AS size")
    for name, stage in corpus_pipeline.STAGES:
        columns, docs = docs.columns, stage(spark, docs, SF)
        path = scratch_path(spark, "odd")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "sharding":
            assert docs.columns == columns
    empty = docs_of(spark).where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_oracles_match(spark):
    from oracle_check import compare, duck
    assert set(registry.oracle_sql()) <= set(registry.queries())
    con = duck(SF)
    for name, sql in registry.oracle_sql().items():
        assert compare(spark, name, registry.queries()[name], sql, SF, con)["status"] == "ok", name
