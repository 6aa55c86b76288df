"""The operators that are plain DataFrame code, against brute force, and their edge cases."""

import math
import struct
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
import xxhash
from pyspark.sql import functions as F

from orbgrid.llm import common, exact_dedup, mixing, sharding, url_filter
from orbgrid.llm.queries import QUERIES, SQL, RULES, TICKETS
from oracle import connect, diff

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert diff(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None


# -- exact dedup ------------------------------------------------------------------------------------


def test_exact_dedup_edges(spark):
    rows = [(1, "Ab"), (2, "aB"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 300_000), (8, "X" * 300_000), (9, "ab"), (9, "ab")]
    docs = spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, text string, keep_id string, _h int")
    out = {r.doc_id: r for r in exact_dedup.exact_dedup(docs).collect()}
    assert (out[1].keep_id, out[1].group_size, out[1].kept) == (9, 4, False)
    assert out[9].kept and (out[3].keep_id, out[3].group_size) == (4, 2)
    assert out[5].kept and out[6].kept and out[7].keep_id == 8
    assert exact_dedup.exact_dedup(docs).count() == len(rows)
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_ascii_lower_leaves_other_letters(spark):
    df = spark.createDataFrame([("AZÀÉİΣ",), ("AZ",), (None,)], "t string")
    assert [r[0] for r in df.select(common.ascii_lower(F.col("t"))).collect()] == ["azÀÉİΣ", "az", ""]


# -- URL rules --------------------------------------------------------------------------------------


def plain_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:]
    path = path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org/es/1", "https://a.example.org/en/19?x=/es/", "http://notexample.org/en/1",
    "http://org/x", "http://b.com/fr/", "http://b.com/de/#/fr/", "http://com", "x://y.com?/fr/", "http://a.b.c.example.org/ES/", "http://é.com/fr/é",
    "http://a..com/fr/", "http://b.com/fr/" + "y" * 100_000,
]


def test_url_rules_against_plain_code(spark):
    rules = [*RULES, ("B.com", "/fr/", "block"), ("b.com", "", "block"), ("", "/x", "block"), (None, "/", "block")]
    named = [(("".join(c.lower() for c in h)), p, v) for h, p, v in rules if h is not None]
    pages = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(URLS + URLS[:3])], "page_id long, url string, host string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = url_filter.judge_urls(pages, table).collect()
    assert len(got) == len(URLS) + 3
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict((URLS + URLS[:3])[r.page_id], named), r.page_id
    assert url_filter.judge_urls(pages.limit(0), table).count() == 0
    none = url_filter.judge_urls(pages, table.limit(0), default="block").collect()
    assert {r.verdict for r in none} == {"block"} and {r.rule for r in none} == {None}


# -- Feistel sharding -------------------------------------------------------------------------------


def plain_place(row, n, key):
    a = math.isqrt(max(n, 1) - 1) + 1
    b = -(-max(n, 1) // a)

    def mixed(value, step, size):
        seed = 42
        for x in (key, step, value):
            seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
        return (seed - (1 << 64) if seed >> 63 else seed) % size

    while True:
        left, right = divmod(row, b)
        for k in range(sharding.ROUNDS):
            if k % 2 == 0:
                left = (left + mixed(right, k, a)) % a
            else:
                right = (right + mixed(left, k, b)) % b
        row = left * b + right
        if row < n:
            return row


@pytest.mark.parametrize("n", [1, 2, 3, 5, 40, 41, 1000])
def test_feistel_is_a_permutation(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n, 7)).collect()]
    assert sorted(got) == list(range(n))
    assert got == [plain_place(r, n, 7) for r in range(n)]


def test_shards_of_whole_table_against_plain_code(spark):
    rows = QUERIES["op10_feistel_shards"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in rows}
    for k, d in enumerate(docs):
        p = plain_place(k, len(docs), 20240611)
        r, raw = got[d.doc_id], (d.text or "").encode()
        assert (r.shard, r.slot, r.size, r.text_crc32) == (p % 40, p // 40, len(raw) + 16, zlib.crc32(raw))
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in counts.items())


def test_sharding_edges(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None), (1, None)], "doc_id long, _m string")
    out = sharding.shard_rows(spark, df, ["doc_id"], 3, 1)
    assert out.columns == ["doc_id", "_m", "row", "shard", "slot"]
    assert sorted(r.row for r in out.collect()) == [0, 1, 2, 3]
    assert sharding.shard_rows(spark, df.limit(0), ["doc_id"], 3, 1).count() == 0
    with pytest.raises(ValueError, match="shard"):
        sharding.shard_rows(spark, df.withColumn("shard", F.lit(1)), ["doc_id"], 3, 1)


# -- mixing -----------------------------------------------------------------------------------------


def plain_period(tickets):
    names, q = sorted(tickets), sum(tickets.values())
    done, out = dict.fromkeys(names, 0), []
    for t in range(q):
        ready = [s for s in names if done[s] < tickets[s] and done[s] * q // tickets[s] <= t]
        pick = min(ready, key=lambda s: (-(-(done[s] + 1) * q // tickets[s]), s))
        out.append((pick, done[pick]))
        done[pick] += 1
    return out


@pytest.mark.parametrize("tickets", [{"a": 1}, {"a": 1, "b": 1}, {"a": 8, "b": 3, "c": 3, "d": 1}, {"a": 17, "b": 5, "c": 1}])
def test_every_prefix_is_within_one_block(spark, tickets):
    table = spark.createDataFrame(list(tickets.items()), "source string, tickets long")
    got = [(r.source, r.k) for r in mixing.period(table).orderBy("slot").collect()]
    assert got == plain_period(tickets)
    q, seen = sum(tickets.values()), Counter()
    for t, (s, _) in enumerate(got, 1):
        seen[s] += 1
        assert all(abs(seen[x] - Fraction(n * t, q)) < 1 for x, n in tickets.items())


@pytest.mark.parametrize("chunk, batch", [(1, 1), (7, 3), (50, 8), (1000, 16)])
def test_period_in_rows_and_batches(spark, chunk, batch):
    tickets = {"a": 17, "b": 5, "c": 1, "": 3, **{f"s{k}": 1 for k in range(9)}}
    table = spark.createDataFrame(list(tickets.items()), "source string, tickets long")
    got = [(r.source, r.k) for r in mixing.period(table, chunk, batch).orderBy("slot").collect()]
    assert got == plain_period(tickets)


def test_fifty_thousand_sources(spark):
    """Each has its share, within a block of it, at any length of the period."""
    table = spark.range(50_000).selectExpr("cast(id AS string) AS source", "1 + id % 3 AS tickets")
    got = mixing.period(table).toPandas()
    q = int(got.total[0])
    assert q == len(got) == got.slot.nunique() == 99_999
    assert (got.slot >= got.k * q // got.tickets).all() and (got.slot < -(-(got.k + 1) * q // got.tickets)).all()
    assert not got.duplicated(["source", "k"]).any() and mixing.period(table.limit(0)).count() == 0


def test_mixture_of_whole_table_against_plain_code(spark):
    rows = QUERIES["op3_pfair_mix"](spark, SF).orderBy("position").collect()
    by = defaultdict(list)
    for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").orderBy("doc_id").collect():
        by[d.source or ""].append(d.doc_id)
    tickets = {s: TICKETS.get(s, 1) for s in by}
    cycle, q, order = plain_period(tickets), sum(tickets.values()), []
    for t in range(q * max(len(v) for v in by.values())):
        s, k = cycle[t % q]
        b = t // q * tickets[s] + k
        order += [(d, b, t) for d in by[s][4 * b : 4 * b + 4]]
    assert [(r.doc_id, r.block, r.slot) for r in rows] == order
    assert [r.position for r in rows] == list(range(len(order)))


def test_mixture_without_broadcast(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source")
    rows = lambda: mixing.mix(spark, docs, TICKETS, block_rows=4).orderBy("position").collect()
    want = rows()
    monkeypatch.setattr(mixing, "BROADCAST_TICKETS", 0)
    assert rows() == want


def test_mixing_edges(spark):
    rows = [(1, None, None), (1, None, "x"), (None, "s", "x"), (2, "s", ""), (2, "s", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, _slot string")
    out = mixing.mix(spark, df, {"s": 2}, names=("b", "s", "p"))
    assert out.columns == ["doc_id", "source", "_slot", "b", "s", "p"]
    assert sorted(r.p for r in out.collect()) == list(range(5))
    assert mixing.mixed_order(spark, df, {"s": 2}).columns == df.columns
    assert mixing.mix(spark, df.limit(0), {}).count() == 0
    order = lambda out: [(r.source, r.position) for r in out.orderBy("position").collect()]
    assert order(mixing.mix(spark, df, {"s": 40}, 20)) == order(mixing.mix(spark, df, {"s": 2}))
    with pytest.raises(ValueError):
        mixing.mix(spark, df, {"s": 0})


def test_a_hot_url_is_split(spark):
    """Three quarters of the rows without a url: the join may deal them to several tasks."""
    from orbgrid.llm import url_filter

    urls = ["NULL", "NULL", "NULL", "concat('https://host', id % 997, '.org/p/', id % 13)"]
    pages = spark.range(40_000).selectExpr("id as page_id", f"case id % 4 when 3 then {urls[3]} end as url")
    rules = spark.createDataFrame([("org", "/", "allow"), ("host1.org", "/p/1", "block")], "host string, path string, verdict string")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = url_filter.judge_urls(pages, rules).withColumn("task", F.spark_partition_id())
        null_rows = [r["count"] for r in out.where("host = ''").groupBy("task").count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(null_rows) == 30_000 and max(null_rows) < 20_000
