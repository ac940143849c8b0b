"""Shards, packed sequences, chats and the pipeline."""

import random
import time
import zlib
from collections import Counter, defaultdict
from itertools import combinations, product

import corpus_pipeline
import pytest
from conftest import FOLDER
from pyspark.sql import functions as F

from larkspur.llm import queries
from larkspur.llm.chat import ALIASES, Costs, repaired_chats
from larkspur.llm.packing import bin_completion, fillings, lower_bound, pack, token_pieces
from larkspur.llm.sharding import histogram_shards


def check_shards(rows, shards, largest):
    load, slots = Counter(), defaultdict(list)
    for r in rows:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(load.values()) / shards
    assert all(abs(load[s] - mean) <= 0.003 * mean + 2 * largest for s in range(shards))


def test_shards_of_tables(spark):
    rows = queries.op3_histogram_shards(spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert Counter(r.doc_id for r in rows) == Counter(texts.keys())
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    check_shards(rows, 16, max(r.size for r in rows))


@pytest.mark.parametrize("n, hot", [(3000, 0.4), (500, 1.0), (5, 0.0), (0, 0.0)])
def test_shards_cut_hot_keys(spark, n, hot):
    rng = random.Random(n)
    rows = [(7 if rng.random() < hot else rng.randrange(-5000, 5000), None if i % 11 == 0 else 1, rng.randint(1, 90), i) for i in range(n)]
    df = histogram_shards(spark.createDataFrame(rows, "a long, b long, size long, shard long"), ["a", "b"], "size", shards=4)
    got = df.collect()
    assert len(got) == n and "shard" in df.columns and df.columns.count("shard") == 1
    if n:
        check_shards(got, 4, 90)


def brute_bins(sizes, capacity):
    best = len(sizes)

    def place(at, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if at == len(sizes):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + sizes[at] <= capacity and bins[i] not in bins[:i]:
                place(at + 1, [*bins[:i], bins[i] + sizes[at], *bins[i + 1 :]])
        place(at + 1, [*bins, sizes[at]])

    place(0, [])
    return best


def test_dominated_fillings_as_written_out():
    """The sums on bit sets against the rule: an unused size could take the place of one to three members."""
    rng = random.Random(6)
    for _ in range(300):
        capacity = rng.randint(6, 90)
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(2, 40)))
        free = counts - Counter([max(counts)])
        for first, *filling in fillings(dict(counts), capacity, 10**6):
            room = capacity - first - sum(filling)
            left = free - Counter(filling)
            parts = [(sum(p), r) for r in (1, 2, 3) for p in combinations(filling, r)]
            worse = any(own + (r == 1) <= x <= own + room for own, r in parts for x in left)
            assert not worse or len(fillings(dict(counts), capacity, 10**6)) == 1


def test_search_over_all_lengths_takes_little_time():
    """A corpus that has every length: 2,000 nodes took 17 seconds while parts were listed one by one."""
    rng = random.Random(2)
    counts = Counter(min(1024, max(1, int(rng.lognormvariate(5.2, 1.0)))) for _ in range(300_000))
    start = time.process_time()
    bin_completion(dict(counts), nodes=2000)
    assert time.process_time() - start < 6


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(8)
    for _ in range(60):
        sizes = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 11))), reverse=True)
        plan = bin_completion(dict(Counter(sizes)), 20)
        used = Counter()
        for times, filling in plan:
            assert sum(filling) <= 20
            for s in filling:
                used[s] += times
        assert used == Counter(sizes)
        bins = sum(t for t, _ in plan)
        assert lower_bound(dict(Counter(sizes)), 20) <= bins == brute_bins(sizes, 20)


def test_pieces_and_places(spark, odd, none):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(queries.tokenizer_paths()[0])
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").unionByName(odd.select(F.col("doc_id") + 10**6, "text").toDF("doc_id", "text"))
    pieces = token_pieces(docs, *queries.tokenizer_paths(), with_ids=True)
    packed = pack(pieces).collect()
    want = Counter()
    for r in docs.collect():
        ids = full.encode(r.text or "", add_special_tokens=False).ids + [2]
        want[r.doc_id, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)), len(ids)] += 1
    parts = defaultdict(dict)
    for r in packed:
        assert len(r.ids) == r.length and zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids)) == r.ids_crc32
        if r.doc_id not in (None, 10**6 + 3):
            parts[r.doc_id][r.piece] = r
    for doc, own in parts.items():
        ids = [i for p in sorted(own) for i in own[p].ids]
        assert want[doc, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)), len(ids)] == 1
        assert [own[p].start for p in sorted(own)] == [sum(own[q].length for q in range(p)) for p in sorted(own)]
        assert all(own[p].length == 1024 for p in own if p)
    places = defaultdict(list)
    for r in packed:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= -(-sum(r.length for r in packed) // 1024) + 2
    assert pack(token_pieces(none, *queries.tokenizer_paths())).count() == 0


def plain_repair(turns, costs):
    """Least cost over every choice of roles and merges, with the insertions each choice needs."""
    best = 0 if not turns else 10**9
    names = [ALIASES.get((r or "").strip().lower(), (r or "").strip().lower()) for r in turns]
    for roles in product(("system", "user", "assistant"), repeat=len(turns)):
        for merges in product((False, True), repeat=len(turns)):
            if any(m and (i == 0 or roles[i] != roles[i - 1]) for i, m in enumerate(merges)):
                continue
            cost = sum(merges) * costs.merge + sum(0 if r == n else costs.relabel if n in ("system", "user", "assistant") else costs.name for r, n in zip(roles, names))
            kept = [r for r, m in zip(roles, merges) if not m]
            if "system" in kept[1:]:
                continue
            chat, expect = kept[1:] if kept[:1] == ["system"] else kept, "user"
            for role in chat:
                if role != expect:
                    cost += costs.insert
                else:
                    expect = "assistant" if expect == "user" else "user"
            cost += costs.insert * (1 if expect == "assistant" else 2 if not chat and kept else 0)
            best = min(best, cost)
    return best


@pytest.mark.parametrize("chunk", [1024, 2])
def test_repair_is_least_cost(spark, chunk):
    rng = random.Random(chunk)
    chats = {c: [rng.choice(["user", "assistant", "system", "User ", "bot", "tool", None]) for _ in range(rng.randint(1, 5))] for c in range(60)}
    rows = [(c, t, r, f"{c}.{t}", "x") for c, roles in chats.items() for t, r in enumerate(roles)]
    got = repaired_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, cost string"), chunk_turns=chunk).collect()
    cost, text = Counter(), defaultdict(str)
    for r in sorted(got, key=lambda r: (r.conv_id, r.part)):
        cost[r.conv_id] += r.cost
        text[r.conv_id] += r.rendered
    for c, roles in chats.items():
        assert cost[c] == plain_repair(roles, Costs()), roles
        seen = [part.split("|>\n")[0] for part in text[c].split("<|") if part and not part.startswith("end")]
        seen = seen[1:] if seen[0] == "system" else seen
        assert seen and seen == ["user", "assistant"] * (len(seen) // 2) and text[c].endswith("<|end|>\n")
        at = [text[c].index(f"{c}.{t}") for t in range(len(roles))]
        assert at == sorted(at)


def test_repair_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(None, None, None, None), (1, 0, "user", None), (1, 0, "user", None), (1, None, "assistant", ""), (2, 0, "user", "x" * 2_000_000), (3, -5, "system", "only"), (4, 1 << 40, "user", "late"), (4, 2, "assistant", "early")]
    got = repaired_chats(spark.createDataFrame(rows, schema)).collect()
    assert sum(r.n_turns for r in got) == len(rows) and {r.conv_id for r in got} == {None, 1, 2, 3, 4}
    assert repaired_chats(spark.createDataFrame([], schema)).count() == 0


def test_pipeline_stages(spark, odd, none):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = None
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            now = docs.count()
            assert before is None or now <= before
            before = now
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.where("piece = 0").count() == before
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, FOLDER).count() == 0, name
        out = stage(spark, odd, FOLDER)
        if name == "packing":  # the long text gives hundreds of pieces, every row one first piece
            assert out.where("piece = 0").count() == odd.count()
        else:
            assert out.columns == odd.columns and out.count() <= odd.count()


def test_pipeline_keeps_one_of_each_group(spark):
    rows = [(5, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (9, "q r s t u v w"), (None, "a b c d e f g"), (7, None), (8, "")]
    out = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER).collect()
    assert sorted((r.doc_id or 0) for r in out) == [0, 2, 7, 8, 9]
