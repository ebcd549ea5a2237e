"""Ball-hashed SimHash, conversation repair and treap search against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cascata.llm import ball_simhash, queries, treap_search, turn_repair

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- SimHash

def brute_print(text, k=3):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_simhash(rows, k=3, radius=2):
    """{id: (fingerprint, component)} by comparing every pair."""
    prints = {i: brute_print(t, k) for i, t in rows}
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (f"{prints[i]:016x}", root(i)) for i in ids}


def simhash(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in ball_simhash.near_duplicates(docs, **how).collect()}


@pytest.mark.parametrize("k,radius", [(3, 2), (1, 1), (2, 3)])
def test_simhash_equals_all_pairs(spark, k, radius, monkeypatch):
    monkeypatch.setattr(ball_simhash, "HOT_ROWS", 3)        # both ways of attaching the component
    monkeypatch.setattr(ball_simhash, "PIECE", 16)
    rng = random.Random(radius)
    rows = []
    for i in range(120):        # long texts with one word changed: fingerprints a few bits apart
        base = [f"w{(i // 12) * 1000 + j}" for j in range(300)]
        base[rng.randrange(300)] = f"x{rng.randrange(3)}"
        rows.append((i, " ".join(base)))
    rows += [(500 + i, t) for i, t in enumerate(
        [None, "", " \t\r\n\x0b\x0c", "one", "ONE", "two words", "Two\twords", "a b c", "A b\n\nc", "É é", "É  é", "é é", "same " * 50, "same " * 80])]
    got = simhash(spark, rows, k=k, radius=radius)
    assert got == brute_simhash(rows, k, radius)
    moved = {c for i, (p, c) in got.items() if i < 120 and got[c][0] != p}
    assert moved or radius == 1         # different fingerprints were linked


def test_simhash_over_the_documents_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op11_ball_simhash(spark, SF).collect()}
    assert got == brute_simhash([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_every_link_within_the_radius(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    values = {centre}
    while len(values) < 60:
        v = rng.choice(sorted(values))
        for _ in range(rng.randint(1, 3)):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed + signed[:5]], "print long")
    for radius in (1, 2, 3):
        got = {(r["a"], r["b"]): r["distance"] for r in ball_simhash.links(frame, radius).collect()}
        want = {(min(a, b), max(a, b)): ((a ^ b) % (1 << 64)).bit_count() for a, b in itertools.combinations(signed, 2)}
        assert got == {p: d for p, d in want.items() if d <= radius}
    with pytest.raises(ValueError):
        ball_simhash.links(frame, 5)


def test_simhash_edge_rows(spark):
    schema = "doc_id long, text string, print string, copies int, `a.b` int, least int"
    rows = [(7, "a b c d", "p", 1, 1, 1), (7, "a b c d", "q", 2, 2, 2), (None, "a b c d", "r", 3, 3, 3), (3, None, "s", 4, 4, 4),
            (None, None, "t", 5, 5, 5), (2, "A B C D", "u", 6, 6, 6)]
    out = ball_simhash.near_duplicates(spark.createDataFrame(rows, schema))
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    p = f"{brute_print('a b c d'):016x}"
    want = [(7, p, 2), (7, p, 2), (None, p, None), (3, "0" * 16, 3), (None, "0" * 16, None), (2, p, 2)]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert ball_simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    long = " ".join(f"w{i}" for i in range(100_000))
    assert simhash(spark, [(1, long)])[1] == (f"{brute_print(long):016x}", 1)


# ---------------------------------------------------------------- conversation repair

def faults_of(rows):
    """(role, text, fault) of rows in order."""
    out, seen = [], set()
    for role, text in rows:
        visible = re.findall("[^\x20\x09-\x0D]", text)
        fault = ("blank" if not visible else "duplicate" if (role, text) in seen
                 else "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def all_repairs(rows):
    """Every (cost, audit, lines) with at most three inserts, by trying all edits."""
    rows = faults_of(rows)

    def walk(at, inserts, cost, audit, lines, initials):
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            yield cost, audit, lines
        if inserts < 3:
            for role in ("user", "assistant"):
                yield from walk(at, inserts + 1, cost + 3, audit + "I", lines + [f"{role}:"], initials + role[0])
        if at < len(rows):
            role, text, fault = rows[at]
            yield from walk(at + 1, inserts, cost + 4, audit + "D", lines, initials)
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if role:
                    yield from walk(at + 1, inserts, cost + extra, audit + "K", lines + [f"{role}:{text}"], initials + role[0])
                for new in ("user", "assistant"):
                    yield from walk(at + 1, inserts, cost + extra + 3, audit + "R", lines + [f"{new}:{text}"], initials + new[0])

    return min(walk(0, 0, 0, "", [], ""), key=lambda x: x[:2])


def test_repair_equals_all_edits(spark, monkeypatch):
    rng = random.Random(11)
    talks = {}
    for c in range(150):
        talks[c] = [(t, rng.choice(["user", "assistant", "system", "tool", ""]),
                     rng.choice(["Yes.", "No!", "cut", " ", "", "Why?\n", f"t{t}."])) for t in range(rng.randint(1, 4))]
    rows = [(c, t, r, x) for c, turns in talks.items() for t, r, x in turns]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(4)
    got = {r["conv_id"]: r for r in turn_repair.digests(frame).collect()}
    lines = {}
    for r in turn_repair.repair(frame).orderBy("conv_id", "position").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for c, turns in talks.items():
        ordered = [(r, x) for t, r, x in sorted(turns)]
        cost, audit, want = all_repairs(ordered)
        assert (got[c]["cost"], got[c]["audit"]) == (cost, audit), ordered
        assert lines.get(c, []) == want
        assert got[c]["repaired_sha256"] == hashlib.sha256("\n".join(want).encode()).hexdigest()
        fault = Counter(f for _, _, f in faults_of(ordered))
        assert [got[c][f] for f in ("blank", "duplicate", "truncated")] == [fault[f] for f in ("blank", "duplicate", "truncated")]
        initials = [r[:1] for r, _ in ordered]
        assert got[c]["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def plain_plan(symbols):
    """(cost, audit) turn by turn, least audits kept forward per state."""
    def closed(best):
        for _ in range(2):
            for state, (cost, audit) in list(best.items()):
                then, new = turn_repair.NEXT[state], (cost + 3, audit + "I")
                best[then] = min(best.get(then, new), new)
        return best

    best = {turn_repair.START: (0, "")}
    for sym in symbols:
        after = {}
        for state, (cost, audit) in closed(best).items():
            for letter, extra, then in turn_repair.row_edits(sym, state):
                new = (cost + extra, audit + letter)
                after[then] = min(after.get(then, new), new)
        best = after
    return min(v for s, v in closed(best).items() if s in (turn_repair.START, turn_repair.ASSISTANT))


@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_runs_of_any_length(chunk, monkeypatch):
    monkeypatch.setattr(turn_repair, "CHUNK", chunk)
    rng = random.Random(chunk)
    for _ in range(60):
        symbols = [s for _ in range(rng.randint(0, 8)) for s in [rng.randrange(9)] * rng.choice([1, 1, 2, 5, 19])]
        runs = turn_repair.Runs()
        for s in symbols:
            runs.add(s)
        assert runs.plan() == plain_plan(symbols)


def test_binary_powers_of_a_long_run():
    for sym in range(9):
        costs = turn_repair.FINISH
        for _ in range(1000):
            costs = turn_repair.apply(turn_repair.power(sym, 0), costs)
        assert turn_repair.advance(sym, 1000, turn_repair.FINISH) == costs
    assert turn_repair.advance(turn_repair.GONE, 10 ** 9, turn_repair.FINISH)[0] == 4 * 10 ** 9


def test_repair_edge_rows(spark):
    schema = "conv_id long, turn long, role string, text string, present boolean, audit string, fault int, seen int"
    rows = [(1, 0, "user", "Hi.", True), (1, 5, "assistant", "Ho.", True), (1, 5, "assistant", "Ho.", True),
            (2, 0, "user", "gone", False), (3, None, None, None, True), (3, None, "user", "A.", True),
            (None, 2, "user", "B.", True), (None, 1, "system", "C.", None), (4, None, "assistant", "z" * 100_000 + ".", True)]
    frame = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], schema).repartition(3)
    got = {r["conv_id"]: tuple(r)[1:-1] for r in turn_repair.digests(frame, present="present").collect()}
    assert got == {1: (4, 0, 1, 0, 1, 4, "KKD"), 2: (0, 0, 0, 0, 0, 0, ""), 3: (0, 1, 0, 0, 1, 7, "DKI"),
                   None: (0, 0, 0, 0, 0, 3, "KI"), 4: (0, 0, 0, 0, 0, 3, "IK")}
    sha = {r["conv_id"]: r["repaired_sha256"] for r in turn_repair.digests(frame, present="present").collect()}
    assert sha[2] == hashlib.sha256(b"").hexdigest()
    assert sha[1] == hashlib.sha256(b"user:Hi.\nassistant:Ho.").hexdigest()
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.digests(empty).count() == 0 and turn_repair.repair(empty).count() == 0


def test_registered_repair_of_the_damaged_table(spark):
    talks = spark.read.parquet(f"{SF}/conversations.parquet")
    by_conv = {}
    for r in talks.collect():
        rows = by_conv.setdefault(r["conv_id"], [])
        role, text = r["role"] or " ", " " if r["text"] is None else r["text"]
        kind = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(r["turn"], role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = {r["conv_id"]: r for r in queries.op12_turn_repair(spark, SF).collect()}
    assert set(got) == set(by_conv)
    for c, rows in by_conv.items():
        rows = faults_of([(r, x) for _, r, x in sorted(rows)])
        symbols = [turn_repair.GONE if f in ("blank", "duplicate") else turn_repair.symbol("sua".find(r[0]) % 4, f == "truncated")
                   for r, _, f in rows]
        assert (got[c]["cost"], got[c]["audit"]) == plain_plan(symbols)


# ---------------------------------------------------------------- treap search

def brute_search(docs, items, k):
    def split(text):
        return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    held = [(i, Counter(split(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(split(t))
    out = []
    for item, ts in wanted.items():
        found = []
        for i, c in held:
            if not c:
                continue
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if missing else i, -s) for r, (s, missing, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def treap(spark, docs, items, k=10):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, treap_search.search(d, i, k).collect()), key=str)


@pytest.mark.parametrize("block,spacing,batch,group", [(1 << 14, 256, 64, 500_000), (7, 1, 1, 500_000), (40, 4, 3, 20)])
def test_search_equals_scoring_everything(spark, block, spacing, batch, group, monkeypatch):
    monkeypatch.setattr(treap_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(treap_search, "SPACING", spacing)
    monkeypatch.setattr(treap_search, "BATCH", batch)
    monkeypatch.setattr(treap_search, "GROUP_TERMS", group)         # several groups of items
    monkeypatch.setattr(treap_search, "PIECE", 5)
    rng = random.Random(block)
    words = [f"w{i}" for i in range(60)] + ["É", "Zz", "9"]
    docs = [(i, " ".join(rng.choices(words, weights=range(1, 64), k=rng.randint(1, 40)))) for i in range(150)]
    docs += [(1000 + i, docs[3][1]) for i in range(30)]              # ties
    docs += [(None, docs[3][1]), (3, docs[3][1]), (3, docs[3][1]), (2000, None), (2001, ""), (2002, " -;\x7f"), (2003, "ÉZz,9_É")]
    items = [(i, "; ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "unheard"), (53, docs[3][1]), (0, "w59"), (None, "w58, É.zz")]
    for k in (1, 10):
        assert treap(spark, docs, items, k) == brute_search(docs, items, k)


def test_search_without_rows(spark):
    assert treap(spark, [], [(1, "a")]) == []
    assert treap(spark, [(1, "a")], []) == []
    assert treap(spark, [(1, None), (2, " ")], [(1, "a")]) == []
    docs = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, n int, `a.term` string")
    items = spark.createDataFrame([(9, "B", "t")], "item_id long, text string, term string")
    assert [r["doc_id"] for r in treap_search.search(docs, items).collect()] == [1]


def test_treap_maxima_and_pruning(monkeypatch):
    monkeypatch.setattr(treap_search, "BATCH", 1)       # only what no bound spares is opened
    rng = np.random.default_rng(2)
    points = np.unique(rng.integers(0, 300, (2000, 2)), axis=0)
    weight = rng.integers(1, 1000, len(points))
    weight[points[:, 1] == 17] += 5000
    grid = treap_search.Treap(points[:, 0], points[:, 1], weight)
    assert grid.high[0] == weight.max() and grid.high[grid.empty] == 0
    opened = [0]
    halves = grid.halves
    grid.halves = lambda p, r, lv: (opened.__setitem__(0, opened[0] + len(lv)), halves(p, r, lv))[1]
    rows = np.unique(points[points[:, 1] == 17, 0])[:3]
    found = {c: s for columns, scores in grid.best(rows, 1, 1) for c, s in zip(columns.tolist(), scores.tolist())}
    want = {c: int(weight[(points[:, 1] == c) & np.isin(points[:, 0], rows)].sum()) for c in range(300)}
    assert found[17] == want[17] == max(want.values())
    assert all(want[c] == s for c, s in found.items())
    assert opened[0] < 100          # of 511 ranges
