"""N-gram join, components, top-k and decontamination against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cascata.llm import block_topk, decontaminate, ngram_join
from cascata.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def brute_components(rows, k, threshold):
    """{id: (n, component)} by comparing every pair."""
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= threshold * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(seed, n_base, copies, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    passage = [rng.choice(vocabulary) for _ in range(25)]
    for _ in range(n_base):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, words))] + passage
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((i, " ".join(text)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,threshold", [(3, 90), (5, 80), (1, 50)])
def test_join_equals_all_pairs(spark, k, threshold, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL", 4)          # many cells and pairs of blocks
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rows = near_copies(k, 25, 9) + [(10_000, None), (10_001, ""), (10_002, " \n\t "), (10_003, "a b"), (10_004, "A  b"),
                                    (10_005, "one"), (10_006, "x " * 50), (10_007, "x " * 70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs, k, threshold).collect()}
    assert got == brute_components(rows, k, threshold)


def test_join_over_the_documents_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs, 3, 90).collect()}
    assert got == brute_components(rows, 3, 90)


@pytest.mark.parametrize("k,threshold,block", [(3, 90, 512), (5, 80, 3), (1, 50, 4)])
def test_all_links_equal_all_pairs(spark, k, threshold, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "LINK_BLOCK", block)          # also components of many blocks
    rows = near_copies(k, 20, 9) + [(10_000, None), (10_001, "a b"), (10_002, "A  b"), (10_003, "x " * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sets = {}
    for i, t in sorted(rows):
        if shingles(t, k) and shingles(t, k) not in sets.values():
            sets[i] = shingles(t, k)
    want = {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets
            if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}
    links, members = ngram_join.linked(docs, k, threshold)
    got = [tuple(r) for r in links.select("class_a", "class_b", "overlap").collect()]
    assert sorted(got) == sorted((*p, c) for p, c in want.items())
    assert k > 1 or len(got) > len({i for p in want for i in p})           # more than connect them
    class_of = {r["doc_id"]: r["class_id"] for r in members.collect()}
    counted = {r["doc_id"]: r["n_links"] for r in ngram_join.join(docs, k, threshold, count_links=True).collect()}
    assert counted == {i: sum(class_of[i] in p for p in want) for i, _ in rows}


def test_hot_group_of_near_copies_is_one_component(spark):
    rng = random.Random(3)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(300):
        text = list(base)
        text[rng.randrange(120)] = f"u{i}"
        rows.append((i, " ".join(text)))
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    assert {r["component_id"] for r in got.collect()} == {0}


def test_rows_compared_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 32)
    search, made = ngram_join.hopeful_across, []
    monkeypatch.setattr(ngram_join, "hopeful_across", lambda cells, *a: (made.append(cells.count()), search(cells, *a))[1])
    for copies in (200, 400):       # one group of near copies, and texts that are near to it but linked with nothing
        rng = random.Random(3)
        rows = []
        for i in range(copies + 30):
            text = [f"t{n}" for n in range(100)]
            for n in rng.sample(range(100), 3 if i < copies else 13):
                text[n] = f"u{i}-{n}"
            rows.append((i, " ".join(text)))
        got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == {i: 0 if i < copies else i for i, _ in rows}
    assert made[0] > 0 and made[1] < 2.6 * made[0]


def test_classes_are_compared_once_for_a_component_and_only_with_sizes_that_allow_a_link(spark, monkeypatch):
    search, made = ngram_join.hopeful_across, []
    monkeypatch.setattr(ngram_join, "hopeful_across", lambda cells, *a: (
        made.extend(r["id"] for r in cells.collect()), search(cells, *a))[1])
    rng = random.Random(5)
    rows = []
    for i in range(80):             # near copies that share many prefix words, and texts near to them without a link
        text = [f"t{n}" for n in range(100)]
        for n in rng.sample(range(100), 3 if i < 60 else 13):
            text[n] = f"u{i}-{n}"
        rows.append((i, " ".join(text)))
    for i in range(80, 170):        # one word shared by three texts of very different lengths
        rows.append((i, " ".join([f"z{i // 3}", *(f"v{i}-{n}" for n in range((10, 40, 160)[i % 3]))])))
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: 0 if i < 60 else i for i, _ in rows}
    # those outside the largest component also meet each other
    assert made and max(made) < 80 and len(made) <= 2 * len(set(made))


def test_a_worker_drops_the_tables_of_the_operator_before():
    import gc
    import weakref

    import public_tokenizers

    from cascata.llm import byte_bpe
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coder = byte_bpe.coder(path, public_tokenizers.PATTERN)
    assert byte_bpe.coder(path, public_tokenizers.PATTERN) is coder
    held = weakref.ref(coder)
    del coder
    assert ngram_join.shingler(3) is ngram_join.shingler(3)
    gc.collect()
    assert held() is None


def test_search_in_arrays_finds_what_search_in_lists_does(monkeypatch):
    rng = np.random.default_rng(7)
    base = rng.choice(1 << 40, 60, replace=False).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 60 - rng.integers(0, 14), replace=False),
                                      rng.integers(0, 1 << 40, 2).astype(np.uint64)])) for _ in range(120)]
    group = [i // 7 * 7 for i in range(120)]
    for known in (None, group):
        in_arrays = ngram_join.search(sets, 80, known)
        with monkeypatch.context() as m:
            m.setattr(ngram_join, "CELL", 1000)
            in_lists = ngram_join.search(sets, 80, known)
        assert in_arrays and sorted(in_arrays) == sorted(in_lists)


def test_keep_one_keeps_columns_and_clean_rows(spark):
    rows = [(5, "a b c d e f g h", "x", 1), (3, "A b c d e f g h", "y", 2), (9, "q r s t u v w", "z", 3),
            (None, "a b c d e f g h", "n", 4), (11, None, "m", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, m int")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["m"] for r in kept.collect()) == [2, 3, 4, 5]


def test_join_of_an_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.join(empty).count() == 0
    twice = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in ngram_join.join(twice).collect())
    assert got == [(1, 1), (1, 1), (2, 1)]


def test_divide_skip_counts_what_sets_share():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(80)]
    index = {}
    for p, s in enumerate(sets):
        for x in s.tolist():
            index.setdefault(x, []).append(p)
    everyone = np.ones(len(sets), bool)
    for q in sets[:20]:
        for needed in (1, 3, 8, 15):
            brute = [(p, len(np.intersect1d(q, s))) for p, s in enumerate(sets)]
            want = [(p, c) for p, c in brute if c >= needed]
            got = dict(ngram_join.divide_skip(q, index, needed, everyone))
            assert set(got) == {p for p, _ in want}
            arrays = {x: np.array(entry) for x, entry in index.items()}
            assert ngram_join.divide_skip(q, arrays, needed, everyone) == want          # whole overlaps, probed in arrays
            some = np.arange(50) % 3 > 0                                                # numbers beyond its end are of none
            assert ngram_join.divide_skip(q, arrays, needed, some) == [x for x in want if x[0] < 50 and x[0] % 3]


def test_slots_are_ranked_by_the_documents_of_all_tasks(spark):
    rows = [(i, f"common words here {i}" + (" rare one there" if i < 3 else "")) for i in range(200)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(4)
    counted = ngram_join.shingle_sets(docs, 3).where("slice is not null")
    ranks = ngram_join.slot_ranks(counted)
    make = ngram_join.Shingler(3)
    rank = {t: int(ranks[ngram_join.slots_of(make.hashes(t))][0]) for t in ("common words here", "rare one there", "none of these")}
    assert rank == {"common words here": int(8 * np.log2(201)), "rare one there": int(8 * np.log2(4)), "none of these": 0}
    none = ngram_join.slot_ranks(ngram_join.shingle_sets(docs.where("id < 0"), 3).where("slice is not null"))
    assert not none.any() and len(none) == ngram_join.SLOTS


def test_histograms_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    sets = []
    for n in (1, 2, 3, 7, 40, 41, 500, 530, 3000):
        base = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        for drop in (0, 1, n // 30, n // 12, n // 4):
            sets.append(np.unique(np.concatenate([base[drop:], rng.integers(0, 1 << 63, drop // 2).astype(np.uint64)])))
    sets = [s for s in sets if len(s)]
    for threshold in (50, 80, 90, 100):
        within = {tuple(sorted(p)) for p in ngram_join.could_link(
            [ngram_join._counts(ngram_join.histogram(s)) for s in sets], threshold)}
        for i in range(len(sets)):
            for j in range(i + 1, len(sets)):
                inter = len(np.intersect1d(sets[i], sets[j]))
                if 100 * inter >= threshold * (len(sets[i]) + len(sets[j]) - inter):
                    assert (i, j) in within


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(200, 260)] + [(7, 7)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    want = {i: 0 for i in range(61)} | {100: 100} | {x: 100 for x in range(200, 260)}
    assert {r["node"]: r["component"] for r in got.collect()} == want


# --- top-k ---------------------------------------------------------------------------------------------------


def brute_top_k(rows, k, is_query):
    usable = [(i, [int(np.floor(256.0 * float(x))) for x in v]) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, qv in usable:
        if not is_query(q):
            continue
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != q and len(v) == len(qv))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_top_k_equals_brute_force_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(600)]
    rows += [(1000 + i, list(rows[0][1])) for i in range(40)]                       # ties
    rows += [(2000, None), (2050, []), (2100, [None] * 6), (2150, [float("nan")] * 6), (2200, [float("inf")] + [0.0] * 5),
             (None, [0.1] * 6), (3000, [1.0, 2.0]), (3050, [0.5, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = block_topk.top_k(frame, F.col("vec_id") % 50 == 0, 5, shard=150, query_group=4)
    assert sorted(map(tuple, got.collect())) == brute_top_k(rows, 5, lambda i: i % 50 == 0)


def test_top_k_with_fewer_candidates_and_large_components(spark):
    rows = [(0, [1e12, 1.0]), (1, [1e12, -1.0]), (2, [-3e9, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, block_topk.top_k(frame, F.col("vec_id") == 0, 5).collect()))
    limit = (1 << 63) - 1
    want = [(q, r, i, max(min(s, limit), -limit - 1)) for q, r, i, s in brute_top_k(rows, 5, lambda i: i == 0)]
    assert got == want
    assert block_topk.top_k(frame.limit(0), F.col("vec_id") == 0, 5).count() == 0


# --- decontamination -----------------------------------------------------------------------------------------


def tokens(text):
    import re
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_hits(docs, items, n=13):
    windows = {}
    for item, text in items:
        w = tokens(text)
        for p in range(len(w) - min(n, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[p:p + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w = tokens(text)
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for p in range(len(w) - size + 1):
                items_here = windows.get(tuple(w[p:p + size]))
                if items_here:
                    hit.update(range(p, p + size))
                    found |= items_here
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def contaminated_rows():
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 3)) for _ in range(rng.randint(14, 30))))
             for i in range(20)] + [(90, "Short Éa item"), (91, ""), (92, None), (93, items_share := "zz yy xx " * 6),
                                    (94, items_share)]
    docs = []
    for d in range(60):
        words = [rng.choice("abcdefgh") + str(rng.randint(0, 3)) for _ in range(rng.randint(0, 80))]
        if d % 3 == 0:
            words[rng.randint(0, len(words)):0] = items[d % 20][1].upper().split()
        docs.append((d, ", ".join(words)))
    docs += [(100, None), (101, ""), (102, "x SHORT éa item"), (103, "short Éa-ITEM!"), (104, "zz yy xx " * 30), (3, "dup id"),
             (105, "İ " + items[0][1])]
    return docs, items


def test_contamination_equals_brute_force(spark):
    docs, items = contaminated_rows()
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit(1)).withColumn("w", F.lit(2))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hash", F.lit(0))
    got = decontaminate.contamination(frame, bench).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got), key=str)
    assert got == brute_hits(docs, items)
    assert decontaminate.contamination(frame.limit(0), bench).count() == 0
    assert decontaminate.contamination(frame, bench.limit(0)).where("n_hit > 0").count() == 0


def test_contamination_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    docs, items = contaminated_rows()
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                      spark.createDataFrame(items, "item_id long, text string")).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got), key=str)
    assert got == brute_hits(docs, items)


def test_shuffled_windows_carry_no_words(spark, monkeypatch):
    """Beyond the broadcast only numbers of positions are shuffled, and long documents stay long once."""
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    rng = random.Random(2)
    long = " ".join(f"v{rng.randrange(500)}" for _ in range(10_000))
    docs = [(1, long), (1, long), (2, long + " one two three"), (3, "short one two three item")]
    items = [(7, " ".join(long.split()[4000:4020])), (8, "one two three"), (9, "absent")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(frame, bench)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got.collect()), key=str) \
        == brute_hits(docs, items)
    plans = []
    real = decontaminate.written
    monkeypatch.setattr(decontaminate, "written", lambda df, name: plans.append(df) or real(df, name))
    decontaminate.contamination(frame, bench)
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    side = [line for line in plan.splitlines() if "explode" in line or "Generate" in line]
    assert side and not any(", w#" in line.split("[", 1)[-1].split("]")[-1] for line in side)
    shuffled = plans[0].select("doc", "p", "size")
    assert shuffled.count() > 0


def test_contaminated_documents_go_and_spans_are_cut(spark):
    docs, items = contaminated_rows()
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("doc", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    bad = {(d, n) for d, n, _, _, c in brute_hits(docs, items) if c}
    kept = decontaminate.remove_documents(frame, bench)
    assert kept.columns == frame.columns
    want = sorted((d, t) for d, t in docs if (d, len(tokens(t))) not in bad)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(want, key=str)
    cut = decontaminate.remove_spans(frame, bench)
    assert cut.columns == frame.columns
    for r in cut.collect():
        source = [t for d, t in docs if d == r["doc_id"]]
        if r["text"] is not None and r["text"] not in source:
            assert len(tokens(r["text"])) < max(len(tokens(t)) for t in source)
    back = {(r["doc_id"], r["text"]) for r in cut.collect()}
    assert (102, "x SHORT éa item") in back and (100, None) in back and (103, "!") in back


def test_capital_sigma_before_other_separators_is_still_a_hit(spark):
    words = "one two three four five six seven eight nine ten \u039f\u0394\u039f\u03a3 \u03b1\u03b2\u03b3 end"
    docs = spark.createDataFrame([(1, words.replace(" \u03b1", ".\u03b1")), (2, words.replace(" \u03b1", "'\u03b1")),
                                  (3, words), (4, words.replace("\u03a3", "\u03c3"))], "doc_id long, text string")
    bench = spark.createDataFrame([("a", words)], "item_id string, text string")
    got = {r["doc_id"]: r["n_hit"] for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: 13, 2: 13, 3: 13, 4: 0}
