"""Tokenizers, token files, counts, language, quality, personal data and chat text against libraries and brute force."""

import base64
import hashlib
import random
import re
import time
import unicodedata
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from cascata.llm import (byte_bpe, chat_format, compression_langid, disclosure_pii, neighbour_quality, queries,
                         token_planes, unigram_counts)
from cascata.llm.common import scratch

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "  ", "\n\n", "a  b", " lead", "tail ", "x \n  y\n\nz", "it's I'LL we've 12 345.6!", "é" * 70,
       "日本語 テスト。ok", "😀😀 <0x41> ▁x▁", "<|endoftext|> text", "\x1c a\x85 b c", "q" * 3000, "ab " * 500, ".,!?\n.\nA",
       "s\n\n'\x85,", "é \n\n1", "\n a", "a\n\n\nb", "_a.b_", "²x.½,3"]


def fuzz(n, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab .,\n!'1é\t▁日😀\x85 sS²_") for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    real = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    return ODD + real + fuzz(400)


@pytest.fixture(scope="module")
def frame(spark, texts):
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(4)


# --- byte-level BPE ------------------------------------------------------------------------------------------


def test_bpe_equals_tiktoken_and_decodes(frame, texts):
    import tiktoken
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = byte_bpe.encode(frame, path, P.PATTERN)
    got = {r["doc_id"]: r for r in encoded.collect()}
    decoded = {r["doc_id"]: bytes(r["decoded"]) for r in byte_bpe.decode(encoded, path, P.PATTERN).collect()}
    digests = {r["doc_id"]: r for r in byte_bpe.round_trip(frame, path, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        want = np.array(own.encode_ordinary(t or ""), "<u4").tobytes()
        assert bytes(got[i]["ids"]) == want, repr(t)
        assert got[i]["n_tokens"] == len(want) // 4 == digests[i]["n_tokens"]
        assert decoded[i] == (t or "").encode()
        assert digests[i]["ids_sha256"] == hashlib.sha256(want).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = random.Random(1)
    for n in (0, 1, 2, 7, 500):
        keys = list({bytes(rng.randrange(256) for _ in range(rng.randint(1, 6))) for _ in range(n)})
        table = byte_bpe.PerfectHash(keys, list(range(len(keys))))
        assert len(table.keys) == len(keys)
        assert [table.get(k) for k in keys] == list(range(len(keys)))
        assert table.get(b"stranger!") is None


def test_memo_forgets_but_stays_right(texts):
    from cascata.llm.chunk_memo import ChunkMemo
    bpe = byte_bpe.coder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    small = ChunkMemo(lambda cuts: [bpe.cut(c) for c in cuts], limit=8)
    want = bpe.encode(texts)
    assert [x for t in texts for x in small.texts([t])] == want
    assert small.texts(texts) == want


def test_memo_takes_columns_and_remembers_cuts_not_what_lies_between_spaces(texts):
    import pyarrow as pa
    from cascata.llm.chunk_memo import ChunkMemo
    bpe = byte_bpe.coder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    odd = [*texts, "a\x00b \x00", "\u3000 a\u3000b", "\U0001F600.\n\U0001F600 \U0001F600", "é.\né\n é", "日.\n日\n\n 日", "\n"]
    memo = ChunkMemo(lambda cuts: [bpe.cut(c) for c in cuts])
    want = [bpe.cut(t or "") for t in odd]
    for kind in (pa.string(), pa.large_string()):
        assert memo.texts(pa.array(odd, kind)) == want
        assert memo.texts(pa.array(odd, kind)[7:-1]) == want[7:-1]
        assert memo.texts(pa.array([], kind)) == [] and memo.texts(pa.array([None, ""], kind)) == [b"", b""]
    few = ["w" + chr(97 + i % 26) + chr(97 + i // 26) for i in range(60)]
    memo = ChunkMemo(lambda cuts: [bpe.cut(c) for c in cuts])
    memo.texts([" ".join(f"{a},\n{b}" for a in few for b in few)])
    assert len(memo.known) < 4 * len(few)


# --- token files ---------------------------------------------------------------------------------------------


def test_token_files_hold_the_library_ids_in_order(spark, frame, texts, monkeypatch):
    monkeypatch.setattr(token_planes, "CHUNK_IDS", 500)
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    for planes in ("bit", "byte"):
        folder = scratch(spark, f"test-{planes}")
        token_planes.write(token_planes.encode(frame, path), folder, planes)
        got = sorted(token_planes.read(spark, folder).collect(), key=lambda r: r["doc_id"])
        crc = {r["doc_id"]: r["ids_crc32"] for r in token_planes.read(spark, folder, digest=True).collect()}
        start = 0
        for r, t in zip(got, texts, strict=True):
            want = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
            assert bytes(r["ids"]) == want, repr(t)
            assert (r["start"], r["n_tokens"]) == (start, len(want) // 4)
            assert crc[r["doc_id"]] == zlib.crc32(want)
            start += r["n_tokens"]


def test_new_words_go_through_the_library_many_to_a_string(texts):
    coder = token_planes.LibraryCoder(P.path("byte_bpe_50k.json"))
    library = coder.tokenizer
    strings = []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            strings.extend(texts)
            return library.encode_batch_fast(texts, **options)

    coder.tokenizer = Counted()
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéß日9-'") for _ in range(rng.randint(1, 12))) for _ in range(6000)]
    cuts = [" " + w for w in words] + [w + "." for w in words] + ["bare", "\n", "a\n", "\na", " \n", " b\nc", "\x1c", "", " ", "  two", " a b", " end\n", " <|endoftext|>", "<|endoftext|>"]
    want = [np.array(library.encode(c, add_special_tokens=False).ids, "<u2").tobytes() for c in cuts]
    assert coder.cuts(cuts) == want
    assert len(strings) < 100
    coder.opens[:] = False      # a vocabulary whose pieces do not show where words begin
    assert coder.cuts(cuts) == want
    assert coder.memo.texts(texts) == [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u2").tobytes()
                                       for t in texts]


def test_token_files_of_nulls_repeats_and_nothing(spark):
    path = P.path("byte_bpe_50k.json")
    rows = spark.createDataFrame([(None, "b"), (1, "a"), (1, "a"), (0, None)], "doc_id long, text string")
    folder = scratch(spark, "test-odd")
    token_planes.write(token_planes.encode(rows, path), folder)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in token_planes.read(spark, folder).collect())
    assert got == [(0, None, 2), (2, 0, 1), (3, 1, 2), (5, 1, 2)]
    folder = scratch(spark, "test-empty")
    token_planes.write(token_planes.encode(rows.limit(0), path), folder)
    assert token_planes.read(spark, folder).count() == 0


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_planes_round_trip(planes):
    rng = np.random.default_rng(2)
    for n, top in ((0, 1), (1, 1), (5, 70_000), (4096, 50_257), (9000, 2), (4097, 1 << 31)):
        ids = rng.integers(0, top, n).astype("<u4")
        width, parts = token_planes.split_planes(ids, planes)
        assert (token_planes.join_planes(n, parts, planes) == ids).all()


# --- unigram counts ------------------------------------------------------------------------------------------


def test_unigram_counts_equal_the_library(frame, texts):
    from tokenizers import Tokenizer, models, pre_tokenizers
    entries = unigram_counts.vocabulary(P.path("piece_bpe_32k.model"))
    library = Tokenizer(models.Unigram(entries, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    got = {r["doc_id"]: r for r in unigram_counts.token_counts(frame, P.path("piece_bpe_32k.model")).collect()}
    for i, t in enumerate(texts):
        assert got[i]["n_tokens"] == len(library.encode(t or "", add_special_tokens=False).ids), repr(t)


def test_normalised_texts_keep_letters_and_are_quick():
    rng = random.Random(9)
    signs = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000] + list("漢𝟗𐄇²½Ⅷ㊀")
    for text in ["".join(signs), *("".join(rng.choices(signs, k=60)) for _ in range(300))]:
        kept = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower())
        assert compression_langid.normalise(text) == " ".join(kept.split())
    text = "éa word and ano ther, then " * 4000
    compression_langid.normalise(text)
    spent = []
    for work in (lambda: compression_langid.normalise(text), lambda: re.sub(r"[\W\d_]+", " ", text.lower())):
        start = time.process_time()
        for _ in range(5):
            work()
        spent.append(time.process_time() - start)
    assert spent[0] < 3 * spent[1]


def test_unigram_one_character_pieces_are_looked_up():
    uni = unigram_counts.UnigramCounter(unigram_counts.vocabulary(P.path("piece_bpe_32k.model")))
    assert "e" not in uni.automaton and "e" in uni.singles
    rng = random.Random(5)
    words = ["▁" + "".join(rng.choice("aeinst'é漢\U0001F600\u0e01.") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    assert uni.segments(words) == [uni.segment(w) for w in words]


def test_unigram_ties_keep_the_longest_last_piece():
    entries = [("<unk>", -9.0), ("▁", 0.0), ("a", -1.0), ("b", -1.0), ("c", -1.0), ("ab", -2.0), ("bc", -2.0), ("abc", -3.0)]
    one = unigram_counts.UnigramCounter(entries)
    assert one.segment("▁abc") == one.segments(["▁abc"])[0] == (2, -3.0)
    assert one.segments(["▁ab", "▁abz", "▁"]) == [one.segment(s) for s in ("▁ab", "▁abz", "▁")]


# --- language ------------------------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    base = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    got = queries.op4_compression_langid(spark, base).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").select("lang_pred", "lang").collect()
    assert len(held) > 100
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)


def test_language_of_odd_texts_and_no_training(spark):
    content = compression_langid.dictionaries({"x": ["alpha beta gamma"] * 3, "y": ["eins zwei drei"] * 3})
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "alpha beta"), (5, "zwei drei " * 5000),
                                  (5, "zwei drei " * 5000)], "doc_id long, text string").withColumn("lang", F.lit("no"))
    got = sorted((r["doc_id"], r["lang_best"], r["score"]) for r in compression_langid.identify(rows, content).collect())
    assert [(d, b) for d, b, _ in got] == [(1, "und"), (2, "und"), (3, "und"), (4, "x"), (5, "y"), (5, "y")]
    assert all(0 <= s <= 1 for _, _, s in got)
    assert {r["lang_best"] for r in compression_langid.identify(rows, {}).collect()} == {"und"}
    labelled = spark.createDataFrame([(1, "a b", None), (2, None, "z"), (3, "ab cd", "z")],
                                     "doc_id long, text string, lang string")
    assert list(compression_langid.train(labelled)) == ["z"]
    assert compression_langid.train(labelled.limit(0)) == {}
    assert compression_langid.identify(rows.limit(0), content).count() == 0


def test_narrow_margins_are_rejected(spark):
    content = compression_langid.dictionaries({"x": ["same words here"] * 3, "y": ["same words here"] * 3})
    rows = spark.createDataFrame([(1, "same words here")], "doc_id long, text string")
    row = compression_langid.identify(rows, content).first()
    assert row["lang"] is None and row["lang_best"] == "x" and row["margin"] == 0.0


def spoken(prefix, n_texts, seed, head="", common=()):
    """Texts of one invented language: a few hundred words, the earlier the commoner."""
    rng = random.Random(seed)
    words = [prefix + "".join(rng.choice("aeioustnrl") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    return [head + " ".join(words[int(len(words) * rng.random() ** 2)] if rng.random() < 0.7 or not common
                            else rng.choice(common) for _ in range(60)) for _ in range(n_texts)]


def test_a_rare_label_leaves_the_other_dictionaries_whole():
    texts = {"x": spoken("k", 80, 1, common=["the", "of"]), "y": spoken("m", 80, 2, common=["der", "von"])}
    alone = compression_langid.dictionaries({lang: own[:60] for lang, own in texts.items()})
    got = compression_langid.dictionaries({lang: own[:60] for lang, own in texts.items()} | {"aa": ["the der foo"]})
    assert {lang: got[lang] for lang in alone} == alone and min(map(len, alone.values())) > 1000
    assert got["aa"] == b"foo "
    model = compression_langid.Compressors(got)
    for lang, own in texts.items():
        assert [model.predict(t)[0] for t in own[60:]] == [lang] * 20


def test_a_language_of_few_texts_wins_its_own():
    texts = {"x": spoken("k", 300, 1), "y": spoken("m", 40, 2)}
    got = compression_langid.dictionaries({"x": texts["x"], "y": texts["y"][:3]})
    assert len(got["y"]) < len(got["x"])
    model = compression_langid.Compressors(got)
    assert [model.predict(t)[0] for t in texts["y"][3:]] == ["y"] * 37


def test_numeric_signs_are_no_letters():
    model = compression_langid.Compressors(compression_langid.dictionaries({"x": spoken("k", 30, 1), "y": spoken("m", 30, 2)}))
    for text in ("\u00bd \u00b2 \u2460", "\u00b2", "\u2167 \u3007 12", "_", "\u0301", ""):
        assert model.predict(text) == ("und", 0.0, 0.0), text
    assert compression_langid.normalise("A\u00b2b \u2460c") == "a b c"


def test_training_reads_whole_texts(spark):
    head = "12345 #### " * 60                                  # no letter for more than 400 characters
    texts = {"x": spoken("k", 30, 1, head), "y": spoken("m", 30, 2, head)}
    rows = [(i, t, lang) for lang, own in texts.items() for i, t in enumerate(own)]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, lang string").repartition(4)
    want = compression_langid.dictionaries({lang: [compression_langid.normalise(t) for t in own]
                                            for lang, own in texts.items()})
    assert len(want["x"]) > 1000 and compression_langid.train(docs) == want
    small = compression_langid.train(docs, size=200)
    assert all(len(c) <= 200 and want[lang].endswith(c) for lang, c in small.items())
    few = compression_langid.train(docs, per_language=3)
    assert all(0 < len(few[lang]) < len(want[lang]) for lang in want)


# --- quality -------------------------------------------------------------------------------------------------


def test_quality_held_out_accuracy(spark):
    base = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "quality")
    got = queries.op1_neighbour_quality(spark, base).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_quality_votes_equal_brute_force(spark):
    base = "/root/testdata/sf0.01"
    model = queries.quality_model(spark, base)
    texts = [None, "", *[r["text"] for r in spark.read.parquet(f"{base}/documents.parquet").limit(40).collect()]]
    got = model.scores(texts)
    assert got[0] == got[1] == model.prior
    assert got[2:].tolist() == [voted(model, model.vector(t)) for t in texts[2:]]


def voted(model, v):
    cos = np.round(model.vectors.astype(float) @ v.astype(float), neighbour_quality.DECIMALS)
    near = sorted(sorted(range(len(cos)), key=lambda i: (-cos[i], i))[:model.neighbours])
    vote = np.clip(cos[near], 0, 1) ** neighbour_quality.POWER * model.weight[near]
    return (vote * model.labels[near]).sum() / vote.sum()


def test_quality_ties_go_to_the_first_of_the_sample():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 8)).astype(np.float32)
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    vectors = base[rng.integers(0, 40, 2000)]                # each about fifty times, with labels of both kinds
    model = neighbour_quality.Model(np.zeros((1, 8)), np.zeros(8), vectors, rng.integers(0, 2, 2000).astype(float),
                                    np.ones(2000), 0.5)
    model.vector = lambda text: base[int(text)]
    texts = [str(i % 40) for i in range(300)]
    one_by_one = [model.scores([t])[0] for t in texts]
    assert model.scores(texts).tolist() == one_by_one == [voted(model, base[int(t)]) for t in texts]


def test_quality_sample_is_the_lowest_hashes_of_each_class(spark, monkeypatch):
    rows = [(i % 700, f"text {i % 900}") for i in range(1000)] + [(5, "text 5")] * 50 + [(None, "x"), (701, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 3 if i % 3 < 2 else None) for i in range(800)], "doc_id long, quality int")
    for slack in (8, 10 ** 9):
        monkeypatch.setattr(neighbour_quality, "SLACK", slack)
        keys, totals = neighbour_quality.sample_keys(docs, labels, "quality", "doc_id", "text", 20)
        got = [(r["y"], r["id"], r["h"]) for r in keys.collect()]
        every = docs.join(labels, "doc_id").where("quality is not null").select(
            F.col("quality").alias("y"), "doc_id", F.xxhash64("doc_id", F.xxhash64("text")).alias("h")).distinct().collect()
        assert totals == {y: sum(r["y"] == y for r in every) for y in (0, 1)}
        for y in (0, 1):
            want = sorted((r["h"], r["doc_id"]) for r in every if r["y"] == y)[:20]
            assert sorted((h, i) for z, i, h in got if z == y) == want


def test_quality_without_labels_and_of_odd_tables(spark):
    rows = spark.createDataFrame([(1, None, None), (2, "some words", None)], "doc_id long, text string, quality int")
    model = neighbour_quality.fit(rows, rows)
    assert [r["score"] for r in neighbour_quality.classify(rows, model).collect()] == [0.5, 0.5]
    one = neighbour_quality.fit(rows, rows.withColumn("quality", F.lit(1)))
    out = neighbour_quality.keep_good(rows.withColumn("score", F.lit("clash")), one, 0.3)
    assert out.columns == ["doc_id", "text", "quality", "score"] and out.count() == 2
    assert neighbour_quality.classify(rows.limit(0), one).count() == 0


# --- personal data -------------------------------------------------------------------------------------------


def plain_spans(text):
    """The contract's patterns as they stand."""
    out = []
    text = text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        if 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns(texts):
    rng = random.Random(4)
    odd = ["".join(rng.choice("a.@-+0123 4().%5é") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    odd += ["4111 1111-1111 1111 x", "+1 (202) 555-0143", "a@b.c.d@e.f.g", "1.2.3.4.5.6.7.8", "256.1.1.1", "@a.b", "a@@b.c.d",
            "000000001.2.3.4", "+4111111111111111", "a@b..c", "x" * 2000 + "@y.zz", "9" * 3000]
    for t in odd + texts:
        assert disclosure_pii.base_spans(t) == plain_spans(t), repr(t)


def corpus_with_secret():
    rows = []
    for i in range(400):
        filler = " ".join(f"w{(i * 7 + j * 13) % 50}" for j in range(12))
        rows.append((i, filler))
    for i in range(5):
        rows.append((1000 + i, f"note {i} w{i} codename zanzibar writes from spy@agency.org about w1 w{i + 9} and w3"))
    for _ in range(30):        # copies of one context prove nothing
        rows.append((2000 + len(rows), "lonely quokka mails one@copy.net today"))
    return rows


def test_terms_that_give_an_entity_away_are_found_and_removed(spark):
    rows = corpus_with_secret()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_terms", F.lit(1)).repartition(4)
    got = {r["doc_id"]: r for r in disclosure_pii.find(docs).collect()}
    assert len(got) == len(rows)
    spans = got[1000]["spans"].split(",")
    text = dict(rows)[1000]
    named = {text[int(a):int(b)] for k, a, b in (s.split(":") for s in spans) if k == "term"}
    assert {"codename", "zanzibar"} <= named and not named & {"w1", "w3"}
    base = disclosure_pii.render(plain_spans(text))
    assert got[1000]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and base in got[1000]["spans"]
    assert got[2000 + 405]["n_term"] == 0 and got[0]["spans"] == ""
    clean = {r["doc_id"]: r["text"] for r in disclosure_pii.sanitise(docs).collect()}
    assert "zanzibar" not in clean[1000] and "[EMAIL]" in clean[1000] and clean[0] == dict(rows)[0]


def test_long_ip_parts_are_numbers_like_others(spark):
    rows = [(1, "ip 1.2.3." + "0" * 5000 + "1"), (2, "ip 1.2.3.1" + "0" * 5000), (3, "0" * 6000 + ".0.0.255 x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_ip"] for r in disclosure_pii.find(docs).collect()}
    assert got == {1: 1, 2: 0, 3: 1}
    clean = {r["doc_id"]: r["text"] for r in disclosure_pii.sanitise(docs).collect()}
    assert clean[1] == "ip [IP]" and clean[2] == rows[1][1] and clean[3] == "[IP] x"


def class_scores(rows):
    """{(entity, term): disclosure} over distinct whole texts, by the definition."""
    texts = {t for _, t in rows if t is not None}
    own = {}
    for t in texts:
        spans = disclosure_pii.base_spans(t)
        words = disclosure_pii._outside(disclosure_pii._words(t), spans)
        own[t] = ({disclosure_pii.entity(k, t[a:b]) for a, k, b in spans}, {w for _, _, w in words if len(w) > 1})
    n, a, out = len(texts), disclosure_pii.SMOOTHING, {}
    for e in set().union(*(es for es, _ in own.values())):
        n_e = sum(e in es for es, _ in own.values())
        for w in set().union(*(ws for es, ws in own.values() if e in es)):
            both = sum(e in es and w in ws for es, ws in own.values())
            n_t = sum(w in ws for _, ws in own.values())
            p = (both + a * n_e / n) / (n_t + a)
            out[e, w] = float(np.log2(p * n / n_e) / np.log2(n / n_e)) if n_e < n else 0.0
    return out


def scored(docs, threshold):
    texts, n = disclosure_pii.distinct_texts(docs)
    return {(r["entity"], r["term"]): r["disclosure"]
            for r in disclosure_pii.scores(disclosure_pii.candidates(disclosure_pii.holdings(texts), n, threshold), n,
                                           threshold).collect()}


def test_scores_equal_brute_force_from_one_text_on(spark):
    rows = corpus_with_secret() + [(3000, None), (3001, ""), (3002, "Far " + "w1 " * 40 + "aim Once@only.org, +1 202 555 0143")]
    got = scored(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), -99.0)
    want = class_scores(rows)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert (disclosure_pii.entity(0, "once@only.org"), "far") in got            # one text, and 40 words off


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.8, 0.95])
def test_terms_that_cannot_reach_the_threshold_never_meet_an_entity(spark, threshold):
    rows = corpus_with_secret()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = {k for k, d in class_scores(rows).items() if d >= threshold}
    assert set(scored(docs, threshold)) == want
    texts, n = disclosure_pii.distinct_texts(docs)
    met = {(r["entity"], r["term"]) for r in disclosure_pii.candidates(disclosure_pii.holdings(texts), n, threshold).collect()}
    assert want <= met and (threshold < 0.8 or len(met) < len(class_scores(rows)))


def test_a_value_in_one_or_two_texts_has_disclosing_terms(spark):
    rows = [(i, f"plain text number n{i} of m{i % 7}") for i in range(600)]
    rows += [(1000, "plain zanzibar text of one@only.org"), (1001, "plain quokka text of two@two.org"),
             (1002, "text by quokka number n5 and two@two.org")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    clean = {r["doc_id"]: r["text"] for r in disclosure_pii.sanitise(docs).collect()}
    assert clean[1000] == "plain [TERM] text of [EMAIL]" and clean[1001] == "plain [TERM] text of [EMAIL]"
    assert clean[1002].startswith("text [TERM] [TERM] number n5 ") and clean[5] == rows[5][1]


def test_term_spans_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    telling = {}
    for (e, w), d in class_scores_of_few(rows).items():
        if d >= disclosure_pii.GENERALISE:
            telling.setdefault(e, set()).add(w)
    want = 0
    for _, t in rows:
        spans = disclosure_pii.base_spans(t)
        terms = set().union(*(telling.get(disclosure_pii.entity(k, t[a:b]), ()) for a, k, b in spans))
        want += sum(w in terms for _, _, w in disclosure_pii._outside(disclosure_pii._words(t), spans)) if terms else 0
    got = sum(r["n_term"] for r in disclosure_pii.find(docs).collect())
    assert got == want > 1000


def class_scores_of_few(rows):
    """``class_scores`` with the terms' counts taken once, as the table is larger."""
    count, held = {}, {}
    texts = {t for _, t in rows if t is not None}
    for t in texts:
        spans = disclosure_pii.base_spans(t)
        words = {w for _, _, w in disclosure_pii._outside(disclosure_pii._words(t), spans) if len(w) > 1}
        for w in words:
            count[w] = count.get(w, 0) + 1
        for e in {disclosure_pii.entity(k, t[a:b]) for a, k, b in spans}:
            held.setdefault(e, []).append(words)
    n, a, out = len(texts), disclosure_pii.SMOOTHING, {}
    for e, sets in held.items():
        for w in set().union(*sets):
            p = (sum(w in s for s in sets) + a * len(sets) / n) / (count[w] + a)
            out[e, w] = float(np.log2(p * n / len(sets)) / np.log2(n / len(sets)))
    return out


def test_copies_of_disclosing_contexts_do_not_hide_them(spark):
    rows = [(i, f"plain text number n{i} of m{i % 7}") for i in range(600)]
    for c in range(3):
        rows += [(1000 + 50 * c + i, f"plain zanzibar text x{c} of spy@agency.org") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    e = disclosure_pii.entity(0, "spy@agency.org")
    got = scored(docs, disclosure_pii.GENERALISE)
    assert got[e, "zanzibar"] == pytest.approx(class_scores(rows)[e, "zanzibar"])
    once = scored(docs.dropDuplicates(["text"]), disclosure_pii.GENERALISE)
    assert got == pytest.approx(once)
    assert all("zanzibar" not in r["text"] for r in disclosure_pii.sanitise(docs).collect())


def test_scores_pass_no_term_through_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame(corpus_with_secret(), "doc_id long, text string").repartition(4)
    want = sorted((r["doc_id"], r["spans"]) for r in disclosure_pii.find(docs).collect())
    assert any("term:" in s for _, s in want)
    monkeypatch.setattr(disclosure_pii, "COUNT_BUFFER", 3)
    monkeypatch.setattr(disclosure_pii, "ROW_BUFFER", 2)
    monkeypatch.setattr(disclosure_pii, "BROADCAST_ROWS", 0)        # all joins by shuffle
    with monkeypatch.context() as m:
        for name in ("collect", "toPandas", "toLocalIterator"):
            m.setattr(type(docs), name, lambda *_: pytest.fail("rows collected"))
        m.setattr(type(spark.sparkContext), "broadcast", lambda *_: pytest.fail("broadcast from the driver"))
        got = disclosure_pii.find(docs)
    assert sorted((r["doc_id"], r["spans"]) for r in got.collect()) == want


def test_personal_data_of_odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "a@b.cc"), (3, "a@b.cc " * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    got = disclosure_pii.find(docs).collect()
    assert sorted(r["n_email"] for r in got) == [0, 0, 0, 1, 2000]
    clean = disclosure_pii.sanitise(docs)
    assert clean.columns == docs.columns
    assert {r["text"] for r in clean.collect()} == {None, "", "[EMAIL]", "[EMAIL] " * 2000}
    assert disclosure_pii.find(docs.limit(0)).count() == 0


# --- chat ----------------------------------------------------------------------------------------------------


def test_chat_round_trip_of_hostile_turns(spark):
    bits = ["<|im_start|>", "<|im_end|>", "<|", "|>", "<", "\\", "<\\|", "<\\\\|im_end|>", "\n", "assistant", "x", "%0A", "%25", "é😀"]
    rng = random.Random(9)
    rows = []
    for c in range(150):
        for t in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", None, "", "<|im_end|>", "a\nb", "%0A", "<\\|%25"])
            rows.append((c, t, role, "".join(rng.choice(bits) for _ in range(rng.randint(0, 8))) or None))
    rows += [(500, 1, "assistant", "same"), (500, 1, "assistant", "same"), (None, 0, "user", "no id"),
             (501, None, "user", "no turn"), (501, 0, "assistant", "y" * 200_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(0))
    out = chat_format.read_back(chat_format.render(frame)).collect()
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    assert len(out) == len(by)
    for r in out:
        want = sorted(by[r["conv_id"]])
        assert r["exact"] and r["n_turns"] == len(want)
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(a, b) for _, a, b in want]
        assert all(t["ok"] for t in r["turns"])
        at, taken = 0, []
        for m in r["loss_mask"]:
            at += m["skip"]
            if m["trained"]:
                taken.append(r["formatted"][at:at + m["take"]])
            at += m["take"]
        back = "".join(re.sub(r"<\\(\\*)\|", r"<\1|", x) for x in taken)
        assert back == "".join(b for _, a, b in want if a == "assistant")
    assert chat_format.render(frame.limit(0)).count() == 0


def test_plain_turns_are_left_as_they_are(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a <| b <|x|> \\ c")], "conv_id long, turn long, role string, text string")
    assert chat_format.render(frame).first()["formatted"] == "<|im_start|>user\na <| b <|x|> \\ c<|im_end|>\n"
