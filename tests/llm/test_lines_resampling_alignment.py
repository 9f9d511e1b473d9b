"""Line dedup, importance resampling and tokenizer alignment against brute force, and their edge cases."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomframe.llm import common, crc_spans, line_dedup, resampling, token_alignment
from loomframe.llm import queries as Q

from .test_llm import DOCS, ODD, SF, odd

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# ---- lines


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(line_dedup.SPACE))


def brute_lines(rows, least=5, chars=40):
    holds = collections.defaultdict(set)
    for i, text in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                holds[key(line)].add(i)
    shared = {k: max(v) for k, v in holds.items() if len(k) >= chars and len(v) >= least}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or shared.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def line_rows(df):
    return sorted((tuple(r) for r in line_dedup.digest(df).collect()), key=str)


@pytest.mark.parametrize("seed,batches,fanout", [(1, 4, 2), (2, 1, 2), (3, 7, 3)])
def test_shared_lines_equal_brute_force(spark, seed, batches, fanout):
    rng = random.Random(seed)
    pool = [f"{'Shared LINE number'} {i} {'ü' * 30}" for i in range(12)] + ["short", "", " \t", "x" * 39, "y" * 40, "é" * 40, "Ä" * 45]
    rows = [(rng.randrange(60), "\n".join(rng.choice(["", " ", "\t"]) + rng.choice(pool[: 1 + rng.randrange(len(pool))]) + rng.choice(["", "\x0c", "\r"]) for _ in range(rng.randrange(9)))) for _ in range(80)]
    rows += [(None, pool[0]), (61, None), (62, ""), (62, ""), (63, "\n".join(pool[:3] * 400)), *[(i, pool[0]) for i in range(100, 140)]]
    df = documents(spark, rows)
    assert line_rows(line_dedup.drop_shared(df, batches=batches, fanout=fanout)) == brute_lines(rows)


def test_line_query_equals_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as from '{SF}/documents.parquet'")
    want = sorted(duck.execute(f"select doc_id, n_lines, n_dropped, kept_sha256 from ({line_dedup.sql()})").fetchall(), key=str)
    got = sorted((tuple(r) for r in Q.op11_line_dedup(spark, SF).collect()), key=str)
    assert got == want and sum(r[2] for r in got) > 0


def test_lines_of_odd_tables(spark):
    out = line_dedup.drop_shared(odd(spark, ["n_lines", "__x", "doc", "h1", "keep"]))
    assert line_rows(out) == brute_lines([r[:2] for r in ODD])
    assert {r.doc_id: r.text for r in out.collect()} == {r[0]: r[1] for r in ODD}
    assert line_dedup.drop_shared(spark.createDataFrame([], DOCS)).count() == 0


def test_runs_are_merged_and_leave_out_what_is_counted(spark):
    tables = common.Tables(spark)
    runs = line_dedup.Runs(spark, tables, least=3, fanout=2)
    for batch in range(5):
        runs.add(spark.createDataFrame([(1, 1, 100 - batch * 10 - i) for i in range(3)] + [(batch, 2, 100 - batch * 10)], "h1 long, h2 long, doc long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    rows = [r for level in runs.levels for n in level for r in spark.table(n).collect()]
    assert [(r.docs, r.keep) for r in rows if (r.h1, r.h2) == (1, 1)] == [(3, 100)]
    assert [tuple(r) for r in runs.shared().collect()] == [(1, 1, 100)]
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("loomframe_")]


# ---- resampling


@given(st.lists(st.binary(min_size=0, max_size=300), min_size=1, max_size=8), st.data())
@settings(max_examples=80, deadline=None)
def test_crc_of_spans(parts, data):
    buf = np.frombuffer(b"".join(parts) + b"z", np.uint8)
    start = np.array([data.draw(st.integers(0, len(buf) - 1)) for _ in range(6)])
    size = np.array([data.draw(st.integers(0, len(buf) - s)) for s in start])
    assert crc_spans.crc32(buf, start, size).tolist() == [zlib.crc32(buf[s : s + n].tobytes()) for s, n in zip(start, size)]


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [zlib.crc32(" ".join(words[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(words) - k + 1)], len(words)


def brute_resample(rows, target, percent=5):
    s, t = collections.Counter(), collections.Counter()
    for _, text in rows:
        s.update(features(text)[0])
    for text in target:
        t.update(features(text)[0])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
    out = []
    for i, text in rows:
        f, n = features(text)
        weight = sum(map(gain, f))
        h = None if i is None else int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in out if r[5] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0], r[1]))
    for k, r in enumerate(fit[: len(fit) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_resampling_equals_brute_force(spark):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").createOrReplaceTempView(name)
    rows = [tuple(r) for r in spark.sql("select doc_id, text from documents").collect()]
    target = [r[0] for r in spark.sql("select text from benchmark").collect()]
    got = sorted((tuple(r) for r in Q.op12_resampling(spark, SF).collect()), key=str)
    assert got == brute_resample(rows, target) and sum(r[4] is not None for r in got) > 5


@pytest.mark.parametrize("chunk", [5, 200, 1 << 17])
def test_resampling_of_odd_and_long_texts(spark, monkeypatch, chunk):
    rng = random.Random(chunk)
    texts = ["", None, "Hello wörld 12 a", "É x\x7fy" + "z" * 300, "q" * 1000 + " end"] + [" ".join(rng.choice(["ab", "Ü", "Foo,bar", "x" * rng.randint(1, 150)]) for _ in range(rng.randrange(60))) for _ in range(40)]
    monkeypatch.setattr(resampling, "CHUNK_BYTES", chunk)
    found = collections.defaultdict(list)
    for bucket, of, _ in resampling.hashed([memoryview((t or "").encode()) for t in texts]):
        for b, d in zip(bucket.tolist(), of.tolist()):
            found[d].append(b)
    assert [sorted(found[d]) for d in range(len(texts))] == [sorted(features(t)[0]) for t in texts]


def test_resampling_edge_cases(spark):
    rows = [(i, "one two three four five " * 5) for i in range(45)] + [(i, "one two three four five " * 5) for i in range(5)] + [(None, "a b c " * 20), (60, None), (61, "")]
    target = spark.createDataFrame([("five one",), (None,)], "text string")
    df = documents(spark, rows).withColumns({"rank": F.lit("x"), "weight": F.lit(1)})
    got = sorted((tuple(r) for r in resampling.resample(df, target, percent=10).collect()), key=str)
    want = brute_resample(rows, ["five one"], 10)
    # equal rows take the places of their tie in any order
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert resampling.resample(documents(spark, []), target).count() == 0
    assert resampling.resample(odd(spark), target.limit(0)).count() == len(ODD)


# ---- alignment


def brute_tokens(text):
    """(n_a, n_b, groups, links) from the whole text's token offsets."""
    both = token_alignment.pair(A, B)
    full = (" " + (text or "")).encode()
    a, b = both.a.encode(" " + (text or ""), add_special_tokens=False).ids, both.b.encode(text or "")
    if not text or b"".join(both.bytes_a[i] for i in a) != full or b"".join(both.bytes_b[i] for i in b) != full:
        return None
    spans = []
    for ids, size in ((a, both.bytes_a), (b, both.bytes_b)):
        ends = np.cumsum([len(size[i]) for i in ids]).tolist()
        spans.append([(e - len(size[i]), e, i) for i, e in zip(ids, ends)])
    low, groups = 0, []
    for cut in sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]}):
        groups.append("|".join(",".join(str(i) for s, _, i in side if low <= s < cut) for side in spans))
        low = cut
    links = collections.Counter((i, j) for s, e, i in spans[0] for s2, e2, j in spans[1] if s < e2 and s2 < e)
    return len(a), len(b), groups, links


def brute_align(rows):
    found = [brute_tokens(t) for _, t in rows]
    count = collections.Counter(x for f in found if f for x in f[3])
    best = collections.Counter()
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for (i, _), f in zip(rows, found):
        if f:
            out.append((i, f[0], f[1], len(f[2]), sum(f[3].values()), sum(n for x, n in f[3].items() if count[x] == best[x[0]]), sum(n * count[x] for x, n in f[3].items()), hashlib.sha256(";".join(f[2]).encode()).hexdigest()))
        else:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
PARTS = [" ", "  ", "\n", "\t", "a", "The", "é", "'s", "don't", "1234", "…", "日本", "▁", "\x00", "<s>", "<|endoftext|>", "<0x41>", "\xa0", "\x85", "\x1c", "😀", "aaaa", "\r\n", ".", ",", "​", "ﬁ", "<unk>", "　"]


@pytest.mark.parametrize("hot", [1, 50, 50_000])
def test_alignment_equals_brute_force(spark, hot):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("length(text) < 1500").collect()]
    # brute force takes the square of a text's length
    rows += [(r[0], r[1] and r[1][:1500]) for r in ODD] + [(5000 + i, "".join(random.Random(i).choice(PARTS) for _ in range(9))) for i in range(150)]
    got = token_alignment.align(documents(spark, rows).withColumn("pair", F.lit("clash")), A, B, hot)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_align(rows)


@given(st.lists(st.sampled_from(PARTS), min_size=1, max_size=12).map("".join))
@settings(max_examples=150, deadline=None)
def test_stretches_align_as_whole_texts(text):
    known = token_alignment.known(A, B)
    sizes, digests, _, link, times = known.documents([text, None, text])
    want = brute_tokens(text)
    assert digests[0] == digests[2] and digests[1] == ""
    assert want is None and digests[0] == "" or (*sizes[0].tolist(), digests[0]) == (want[0], want[1], len(want[2]), sum(want[3].values()), hashlib.sha256(";".join(want[2]).encode()).hexdigest())


def test_a_worker_forgets_and_aligns_the_same(monkeypatch):
    texts = ["The quick brown fox " * 3, "jumps\nover don't", "日本 the fox"]
    plain = token_alignment.Known(token_alignment.pair(A, B)).documents(texts)
    monkeypatch.setattr(token_alignment, "MEMO", 2)
    small = token_alignment.Known(token_alignment.pair(A, B))
    again = [small.documents(texts), small.documents(texts)]
    for got in again:
        assert all(np.array_equal(x, y) for x, y in zip(got, plain))


def test_alignment_of_long_texts(spark):
    one, many = (token_alignment.align(documents(spark, [(1, t)]), A, B).first() for t in ("word " * 100, "word " * 60_000))
    assert [many[c] - one[c] for c in ("n_a", "n_b", "n_groups", "n_links")] == [59_900] * 4


def test_alignment_of_an_empty_table(spark):
    assert token_alignment.align(documents(spark, []), A, B).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/check_h"), reason="tables of the check tool")
def test_line_runs_over_many_partitions(spark):
    docs = spark.read.parquet("/root/testdata/check_h/documents.parquet").where("doc_id % 20 = 0").select("doc_id", "text")
    assert line_rows(line_dedup.drop_shared(docs)) == brute_lines([tuple(r) for r in docs.collect()])
