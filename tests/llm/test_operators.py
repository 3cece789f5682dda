"""The ten operators against brute force, and over odd tables."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash

from spanforge.llm import common, langid, line_crf, line_dedup, media_audio, mixing, near_copies, packing, quality_rules, sharding, simhash, sql, toxicity
from spanforge.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns whose names clash with the operators' own working columns.
ODD = SCHEMA + ", key_a string, w int, kept boolean, document string, p int, fp string, size string, copies string, hash int, lang_pred string"


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    lines = [prose(rng, rng.randint(1, 30)) for _ in range(40)]
    out = []
    for _ in range(60):
        body = [rng.choice(lines) if rng.random() < 0.6 else prose(rng, rng.randint(1, 20)) for _ in range(rng.randint(1, 14))]
        if rng.random() < 0.3:
            at = rng.randint(0, 30)
            body += lines[at : at + 6]
        out.append("\n".join(body))
    out += out[:5] + ["", None, " \t\n\r", "a" * 5000, "x y z\n" * 200, "déjà vu ÀB ÉCOLE öß", "same same " * 50]
    return out


def table(spark, texts, schema=SCHEMA):
    n = len(schema.split(","))
    rows = [((None if i % 17 == 16 else i), t, None if i % 13 == 12 else "en", None if i % 11 == 10 else f"s{i % 4}", len(t or ""), *[None] * (n - 5)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts).cache()


def expected_counts(t):
    w, t = WORD.findall(t or ""), t or ""
    c = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    worded = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(worded) - len(set(worded)), len(covered)


def test_quality_counts(docs, texts):
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.score(docs).collect())
    want = collections.Counter()
    for i, t in enumerate(texts):
        c = expected_counts(t)
        want[(None if i % 17 == 16 else i, *c, c[0] < 20 or 100 * c[4] > 30 * c[0])] += 1
    assert got == want


def test_quality_limits_reject_outliers(spark):
    rng = random.Random(1)
    clean = [prose(rng, 60) for _ in range(150)]
    junk = [" ".join(f"{w}***" for w in prose(rng, 60).split()) for _ in range(10)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(clean + junk)], SCHEMA)
    kept = {r.doc_id for r in quality_rules.keep(df).collect()}
    assert kept == set(range(150))


@pytest.mark.parametrize("percent", [26, 30, 40, 50])
def test_quality_limits_hold_in_dirty_sources(spark, percent):
    rng = random.Random(2)
    junk = 150 * percent // (100 - percent)
    texts = [prose(rng, 60) for _ in range(150)] + [" ".join(f"{w}***" if k % 3 else w for k, w in enumerate(prose(rng, 60).split())) for _ in range(junk)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    assert {r.doc_id for r in quality_rules.keep(df).collect()} == set(range(150))


def marked(rng, n, share):
    """Prose in which about that share of words carries a symbol."""
    return " ".join(f"{w}#" if rng.random() < share else w for w in prose(rng, n).split())


def test_quality_limits_follow_a_sources_habit(spark):
    rng = random.Random(3)
    plain = [(i, prose(rng, 200), "en", "plain", 0) for i in range(150)]
    code = [(200 + i, marked(rng, 200, rng.uniform(0.02, 0.12)), "en", "code", 0) for i in range(150)]
    same = marked(random.Random(4), 200, 0.1)
    df = spark.createDataFrame([*plain, *code, (400, same, "en", "plain", 0), (401, same, "en", "code", 0)], SCHEMA)
    kept = {r.doc_id for r in quality_rules.keep(df).collect()}
    assert 401 in kept and 400 not in kept and len(kept) >= 298
    limits = {r.source: r for r in quality_rules.thresholds(quality_rules.with_metrics(df)).collect()}
    assert limits["code"].max_symbol_rate > 5 * limits["plain"].max_symbol_rate


def test_quality_limits_differ_by_length_and_shape(spark):
    """Limits of three rates and more come from the sketches, and no constant explains all rejections."""
    rng = random.Random(5)
    rows = [(i, marked(rng, 60 if i % 2 else 400, 0.01 if i % 2 else 0.05) + "\n" + "long" * (i % 2) * 9, "en", f"s{i % 2}", 0) for i in range(300)]
    limits = quality_rules.thresholds(quality_rules.with_metrics(spark.createDataFrame(rows, SCHEMA))).collect()
    assert sum(len({r[f"max_{k}"] for r in limits}) == 2 for k in quality_rules.RATES) >= 3
    few = [(i, prose(rng, 60), "en", "s", 0) for i in range(10)]
    assert len({r.max_symbol_rate for r in quality_rules.thresholds(quality_rules.with_metrics(spark.createDataFrame([*rows, *few], SCHEMA))).collect()}) == 3


def test_sketches_merge(spark, docs):
    """Adding up the sketches of two halves is the sketch of the whole."""
    m = quality_rules.with_metrics(docs.select("doc_id", "text", "lang", "source")).cache()
    halves = [quality_rules.sketches(m.where(c)) for c in ("doc_id % 2 = 0", "doc_id % 2 <> 0 OR doc_id IS NULL")]
    keys = ["lang", "source", "rate", "edge"]
    merged = halves[0].union(halves[1]).groupBy(*keys).agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")
    assert sorted(map(str, merged.collect())) == sorted(map(str, quality_rules.sketches(m).select(*keys, "n").collect()))


def test_quality_sql(spark, docs, texts):
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(sql.ORACLE_SQL["op1_quality_rules"]).df()
    got = quality_rules.score(docs).select(*want.columns).toPandas()
    told = lambda df: collections.Counter(tuple(None if pd.isna(x) else int(x) for x in r) for r in df.itertuples(index=False))
    assert told(got) == told(want)


def test_columns_of_another_case(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(i, prose(rng, 60), "en", "s") for i in range(80)], "Doc_ID int, Text string, LANG string, Source string")
    assert quality_rules.keep(df).count() == 80 and quality_rules.keep(df).columns == df.columns
    assert line_dedup.dedup(df).columns == df.columns and mixing.mix(df).columns == df.columns and near_copies.keep(df).count() == 80
    with pytest.raises(TypeError, match="integer"):
        simhash.near_duplicates(df.selectExpr("cast(Doc_ID as string) doc_id", "Text"))


@pytest.mark.parametrize("few", [1, 3, 100])
def test_group_join_beyond_its_broadcast(spark, few):
    rows = spark.createDataFrame([(k, None if k % 5 == 4 else f"s{k % 5}") for k in range(60)], "k int, source string")
    groups = rows.groupBy("source").count().withColumnRenamed("count", "n")
    met = common.group_join(rows, groups, ["source"], "n", few)
    assert sorted(r.k for r in met.collect()) == list(range(60)) and set(met.columns) == {"k", "source", "n"}


def test_sketch_buckets(spark):
    values = [0, 1, 63, 64, 65, 127, 128, 1000, 123_456_789]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    for v, edge in df.select("v", quality_rules.bucket(df["v"])).collect():
        assert edge <= v and v - edge <= v / 32


def brute_lines(rows, min_words):
    """Lines of each (doc, text) that lie in a run of min_words words or more found earlier."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
    flat = []
    for key in order:
        flat += [(key, at, x) for at, x in enumerate(key[1].split("\n")) if WORD.search(x)] + [None]
    gone = collections.defaultdict(set)
    for p, q in itertools.product(range(len(flat)), repeat=2):
        if q < p and flat[p] and flat[q] and flat[p][2] == flat[q][2] and not (q and flat[p - 1] and flat[q - 1] and flat[p - 1][2] == flat[q - 1][2]):
            n = words = 0
            while p + n < len(flat) and flat[p + n] and flat[q + n] and flat[p + n][2] == flat[q + n][2]:
                words += len(WORD.findall(flat[p + n][2]))
                n += 1
            if words >= min_words:
                gone[flat[p][0]].update(flat[p + k][1] for k in range(n))
    return gone


@pytest.mark.parametrize("min_words", [1, 12, 50])
def test_line_dedup(spark, texts, min_words):
    # ids are repeated, with other texts and with the same one, and some are null
    rows = [(None if i % 7 == 6 else i // 2, t) for i, t in enumerate(texts)] + [(3, texts[7]), (3, texts[7]), (None, texts[6])]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).repartition(3)
    gone = brute_lines([r for r in rows if r[1] is not None], min_words)
    want = collections.Counter((i, None if t is None else "\n".join(x for at, x in enumerate(t.split("\n")) if at not in gone[(i, t)])) for i, t in rows)
    assert collections.Counter((r.doc_id, r.text) for r in line_dedup.dedup(df, min_words).collect()) == want
    if min_words == line_dedup.MIN_WORDS:
        con = duckdb.connect()
        con.register("documents", pd.DataFrame([(i, t) for i, t in rows], columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
        assert collections.Counter((i, t) for i, t, *_ in con.execute(sql.ORACLE_SQL["op5_line_dedup"]).fetchall()) == want


def test_one_line_in_most_documents(spark):
    """A line that most documents hold, beyond the share at which keys are broadcast."""
    rng = random.Random(8)
    rows = [(i, "\n".join(["the very common line", prose(rng, 20), *(["the other common line"] * (i % 3))])) for i in range(120)]
    rows += [(200 + i, rows[i][1]) for i in range(40)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    gone = brute_lines(rows, 24)
    want = {i: "\n".join(x for at, x in enumerate(t.split("\n")) if at not in gone[(i, t)]) for i, t in rows}
    assert {r.doc_id: r.text for r in line_dedup.dedup(df, 24).collect()} == want


def brute_fingerprint(t):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(prints):
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= 4:
            root[find(a)] = find(b)
    return {f: find(f) for f in prints}


def test_fingerprints(texts):
    for t in texts:
        assert simhash.fingerprint(t or "") == brute_fingerprint(t)


def test_golay_covering():
    values = np.random.default_rng(0).integers(0, 1 << 23, 300)
    code = np.flatnonzero(simhash.syndrome(np.arange(1 << 23)) == 0)
    assert len(code) == 4096
    row, anchor, home = simhash.anchors(values)
    for k, v in enumerate(values):
        near = np.bitwise_count(code ^ v)
        assert set(anchor[row == k].tolist()) == set(code[near <= 4].tolist())
        assert near.min() <= 3 and set(anchor[(row == k) & home].tolist()) == set(code[near <= 3].tolist())


@pytest.mark.parametrize("part", [20_000, 3])
def test_links_and_components(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for f in list(prints)[:60]:
        for _ in range(rng.randint(1, 6)):  # chains of neighbours
            for k in rng.sample(range(64), rng.randint(1, 5)):
                f ^= 1 << k
            prints.add(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in prints]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(signed)] + [(None, signed[0]), (1000, signed[0])], "doc_id bigint, fp bigint")
    roots = brute_components(prints)
    least = {}
    for i, f in enumerate(prints):
        least[roots[f]] = min(least.get(roots[f], 1 << 60), i)
    got = {r.fp % (1 << 64): r.component_id for r in simhash.components(df).collect()}
    assert got == {f: least[roots[f]] for f in prints}


def test_near_duplicates(docs, texts):
    got = collections.Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    ids = [None if i % 17 == 16 else i for i in range(len(texts))]
    prints = [brute_fingerprint(t) for t in texts]
    roots = brute_components(set(prints))
    least = {}
    for i, f in zip(ids, prints):
        if i is not None:
            least[roots[f]] = min(least.get(roots[f], 1 << 60), i)
    assert got == collections.Counter((i, f"{f:016x}", least.get(roots[f])) for i, f in zip(ids, prints))
    kept = simhash.keep(docs).collect()
    assert len(kept) == len(set(roots.values())) and {r.doc_id for r in kept} >= set(least.values())


def test_packing(docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter()
    for i, x in enumerate(texts):
        want[(None if i % 17 == 16 else i, tuple(t.encode(x or "", add_special_tokens=False).ids + [2]))] += 1
    capacity = 256
    rows = packing.pack(docs, tokenizer_path(), capacity).collect()
    spans = collections.defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length))
    filled = []
    for s in spans.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))]
        filled.append(sum(n for _, n in s))
    assert max(filled) <= capacity and all(f == capacity or f & (f - 1) == 0 for f in filled)
    assert sum(r.length for r in rows) == sum(len(ids) * n for (_, ids), n in want.items())
    for (i, ids), n in want.items():
        if i is None or n > 1:
            continue
        own = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == i)
        at = 0
        for start, length, crc, total in own:
            assert start == at and total == len(ids) and crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)


def test_sum_of_squares_rule():
    rng = random.Random(3)
    packer = packing.Packer(32, 10**6)
    levels = collections.Counter()
    for _ in range(2000):
        size = rng.randint(1, 31)
        options = {h: sum(v * v for v in {**levels, h: levels[h] - (h > 0), **({h + size: levels[h + size] + 1} if h + size < 32 else {})}.values()) for h in [0, *[h for h, v in levels.items() if v and h + size <= 32]]}
        chosen = packer.choose(size)
        assert options[chosen] == min(options.values())
        levels[chosen] -= chosen > 0
        levels[chosen + size] += chosen + size < 32
        packer.place((0, 0, bytes(4 * size), size), size)
        assert {h: v for h, v in levels.items() if v} == {h: int(v) for h, v in enumerate(packer.level) if v}


def test_encoder_matches_whole_texts(texts):
    e = packing.Encoder(tokenizer_path())
    rng = random.Random(2)
    odd = ["".join(rng.choices("aB1'sé́ \u0085\x1c <|>.,! \n\t" + "ñ中", k=60)) for _ in range(200)] + ["a<|endoftext|>b c", "<|startoftext|>"]
    for t in [*odd, *texts]:
        assert e.ids(t or "") == e.raw(t or "") + e.end


def test_mixing(docs, texts):
    rows = mixing.taken(docs).collect()
    sizes = collections.Counter()
    for i, t in enumerate(texts):
        sizes[None if i % 11 == 10 else f"s{i % 4}"] += len(WORD.findall(t or ""))
    names = sorted(k for k in sizes if k is not None) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    goal, held = {}, set()
    while True:
        level = (1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in held)) / sum(weight[s] for s in names if s not in held)
        over = {s for s in names if s not in held and weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        held |= over
    goal = {s: 2 * sizes[s] if s in held else weight[s] * level for s in names}
    got, total = {}, collections.Counter()
    for r in rows:
        assert r.taken <= 2 * r.size and r.taken == r.size * r.copies
        got[r.source_size] = r.target
        total[r.source_size] += r.taken
    assert got == pytest.approx({sizes[s]: goal[s] for s in names})
    for s in names:
        assert abs(total[sizes[s]] - goal[s]) <= 220
    assert sorted(map(str, rows)) == sorted(map(str, mixing.taken(docs).collect()))
    mixed = collections.Counter(r.doc_id for r in mixing.mix(docs).collect() if r.doc_id is not None)
    assert mixed == collections.Counter({r.doc_id: r.copies for r in rows if r.copies and r.doc_id is not None})


def test_flight_keeps_totals():
    rng = np.random.default_rng(1)
    size, n = rng.integers(0, 500, 2000).astype(float), np.ones(2000)
    p = mixing.flight(np.full(2000, 0.37), n, size, 5)
    assert ((p > 0) & (p < 1)).sum() <= 2
    assert p.sum() == pytest.approx(0.37 * 2000) and (p * size).sum() == pytest.approx(0.37 * size.sum())
    mean = np.mean([mixing.flight(np.full(9, 0.4), np.ones(9), np.arange(9.0), k) for k in range(4000)], 0)
    assert np.abs(mean - 0.4).max() < 0.04


@pytest.mark.parametrize("limit", [300, 2000, 10**9])
def test_sharding(docs, texts, limit):
    rows = sharding.assign(docs, limit).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(None if i % 17 == 16 else i for i in range(len(texts)))
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        assert f"{r.hash:060b}".startswith(r.shard.split("/")[0]) and len(r.shard.split("/")[0]) == r.bits
    whole = collections.Counter()
    for r in rows:
        for d in range(61):
            whole[f"{r.hash:060b}"[:d]] += r.n_bytes
    for shard, members in by.items():
        assert {m.shard_bytes for m in members} == {sum(m.n_bytes for m in members)}
        assert members[0].shard_bytes <= limit or len(members) == 1
        if "/" not in shard and shard:
            assert whole[shard[:-1]] > limit  # its parent had to split


@pytest.mark.parametrize("limit", [2000, 1 << 20])
def test_sharding_sql(spark, docs, texts, limit):
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    query = sql.ORACLE_SQL["op4_sharding"].replace(str(sharding.LIMIT // 2), str(limit // 2)).replace(str(sharding.LIMIT), str(limit))
    want = con.execute(query).fetchall()
    got = sharding.assign(docs, limit).select("doc_id", "n_bytes", "hash", "shard", "bits", "shard_bytes").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)


def test_sharding_writes_every_row(spark, tmp_path):
    rows = [(1, "x" * 600, f"{k}", "u", 7, "s") for k in range(20)] + [(k, "y" * 500, "z", "v", k, None) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _id string, _hash string, uid int, shard string")
    name = sharding.write(df, str(tmp_path / "out"), 2000)
    assert name == "_shard"
    back = spark.read.parquet(str(tmp_path / "out"))
    assert collections.Counter(map(tuple, back.select(*df.columns).collect())) == collections.Counter(rows)
    sums = collections.Counter()
    for r in back.collect():
        sums[r[name]] += len(r.text)
    assert max(sums.values()) <= 2000 and all(k.startswith("b") for k in sums)
    assert sharding.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "none")) == "shard"


def test_audio(docs, texts):
    for r in media_audio.audio_features(docs).collect():
        samples, rate = media_audio.from_wav(bytes(r.media))
        assert rate == media_audio.RATE and len(samples) == r.payload_bytes and r.payload_bytes % 64 == 0 and r.payload_bytes > 0
        raw = samples[: r.n_bytes]
        assert set(samples[r.n_bytes :]) <= {0} and len(samples) - r.n_bytes < 64 + (r.n_bytes == 0)
        if r.doc_id is not None:
            assert raw.decode() == (texts[r.doc_id] or "")
        assert r.tail_crc32 == zlib.crc32(samples[-64:]) and r.media_bytes == len(r.media)
        blocks, frames = media_audio.from_tensors(bytes(r.tensors))
        assert blocks.shape[1:] == (media_audio.BLOCK, media_audio.MELS) and (frames[:-1] == media_audio.BLOCK).all()
        mels, spans = media_audio.features(samples)
        flat = blocks.reshape(-1, media_audio.MELS)
        assert (flat[: len(mels)] == mels).all() and (flat[len(mels) :] == np.log(np.float32(media_audio.FLOOR))).all() and frames.sum() == len(mels)
        assert [(s.start, s.end) for s in r.spans] == spans
        assert media_audio.describe(bytes(r.tensors), spans) == r.feature


def test_audio_feature_is_of_real_frames():
    """Padding of the last block takes no part in the means, so short texts differ."""
    def told(text):
        mels, spans = media_audio.features(media_audio.payload_of(text)[1])
        return media_audio.describe(media_audio.to_tensors(mels), spans)

    assert told("").split("mel=")[1] != told("hello there my friend").split("mel=")[1]
    mels, _ = media_audio.features(media_audio.payload_of("abc " * 500)[1])
    times = media_audio.pa.ipc.open_stream(media_audio.to_tensors(mels)).read_all()
    assert times.column("start").to_pylist()[1:] == times.column("end").to_pylist()[:-1]


def test_mels_against_the_definition():
    rate, frame, mels = 10_000.0, media_audio.FRAME, media_audio.MELS
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = [700 * (10 ** (k * mel(rate / 2) / (mels + 1) / 2595) - 1) for k in range(mels + 2)]
    bank = np.zeros((frame // 2 + 1, mels))
    for k in range(frame // 2 + 1):
        f = k * rate / frame
        for m in range(mels):
            a, b, c = edges[m : m + 3]
            bank[k, m] = (f - a) / (b - a) if a <= f <= b else (c - f) / (c - b) if b < f <= c else 0
    assert media_audio.mel_bank(rate) == pytest.approx(bank, abs=1e-5)
    y = np.random.default_rng(3).normal(0, 0.3, 1000).astype(np.float32)
    got, energy = media_audio.log_mels(y)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(frame) / frame)
    for i in range(len(got)):
        part = np.zeros(frame)
        own = y[i * media_audio.HOP : i * media_audio.HOP + frame]
        part[: len(own)] = own
        part *= window
        power = [abs(sum(part * np.exp(-2j * np.pi * k * np.arange(frame) / frame))) ** 2 for k in range(frame // 2 + 1)]
        assert got[i] == pytest.approx(np.log(np.array(power) @ bank + media_audio.FLOOR), abs=1e-3)
        assert energy[i] == pytest.approx(np.log((part**2).sum() + media_audio.FLOOR), abs=1e-4)
    assert len(got) == 1 + -(-(1000 - frame) // media_audio.HOP)


@pytest.mark.parametrize(("up", "down", "n"), [(5, 8, 1000), (3, 2, 257), (1, 2, 64), (7, 3, 5)])
def test_resample(up, down, n):
    x = np.random.default_rng(0).normal(size=n).astype(np.float32)
    bank = media_audio.filters(up, down)
    taps = bank.shape[1]
    got = media_audio.resample(x, up, down, bank)
    want = [sum(bank[k * down % up][j] * x[i] for j in range(taps) if 0 <= (i := k * down // up - j + taps // 2) < n) for k in range(-(-n * up // down))]
    assert got == pytest.approx(np.array(want), abs=1e-4)


def test_spans():
    e = np.random.default_rng(0).normal(size=500)
    on, want = False, []
    for x in e:
        on = x >= 1 or (on and x >= -0.5)
        want.append(on)
    got = np.zeros(500, bool)
    for a, b in media_audio.active_spans(e, 1, -0.5):
        assert not got[a:b].any()
        got[a:b] = True
    assert got.tolist() == want


def test_marginals():
    rng = np.random.default_rng(0)
    counts = np.array([3, 0, 1, 5])
    unary, pair = rng.normal(size=(9, 2)), rng.normal(size=(2, 2))
    p, moves = line_crf.marginals(unary, pair, counts)
    at, want_moves = 0, np.zeros((2, 2))
    for n in counts:
        total, own, step = 0.0, np.zeros((n, 2)), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(unary[at + k, y[k]] for k in range(n)) + sum(pair[a, b] for a, b in zip(y, y[1:])))
            total += w
            for k in range(n):
                own[k, y[k]] += w
            for a, b in zip(y, y[1:]):
                step[a, b] += w
        assert p[at : at + n] == pytest.approx(own / total)
        want_moves += step / total
        at += n
    assert moves == pytest.approx(want_moves)


def labelled(spark, junk, value):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        bad = i % 2
        rows.append((i, "\n".join(junk(rng, prose(rng, 25)) if bad else prose(rng, 25) for _ in range(4)), "en", "s", 0, bad))
    df = spark.createDataFrame(rows, SCHEMA + ", bad int")
    return df.drop("bad"), df.selectExpr("doc_id", f"bad as {value}" if value == "toxic" else f"1 - bad as {value}")


def test_crf_held_out(spark, docs):
    df, labels = labelled(spark, lambda r, t: " ".join(f"{w}$$$" for w in t.split()), "quality")
    model = line_crf.train(df, labels)
    rows = line_crf.score(df, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.predicted == 1 - r.doc_id % 2 for r in rows if r.held_out]) > 0.95
    assert all(0 <= r.score <= 1 for r in line_crf.score(docs, model).collect())


def test_toxicity_held_out_and_misspelt(spark, docs):
    def insult(rng, t):
        w = t.split()
        w[3] = rng.choice(["worthless", "idiot", "pathetic"])
        return " ".join(w)

    df, labels = labelled(spark, insult, "toxic")
    model = toxicity.train(df, labels)
    rows = toxicity.score(df, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.predicted == r.doc_id % 2 for r in rows if r.held_out]) > 0.9
    t = model.table()
    rest = "abc deff gah bb " * 6
    clean, exact, bent = model.scores([rest + "deff", rest + "worthless", rest + "worthles"], t)
    assert clean < 0.5 < 0.7 < min(exact, bent)
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())


def test_kneser_ney_sums_to_one():
    counts = langid.Counts(["ab", "abc", "bca", "cab"], np.array([3, 2, 1, 5]))
    words = [f"ab{c}" for c in "abcxyz "]
    for keys, _, contexts, weight in counts.tables:
        assert (np.diff(keys.astype(object)) > 0).all() and (np.diff(contexts.astype(object)) > 0).all() and (weight <= 1).all()
    codes, lengths = langid.flat_codes(words, " ", " ")
    grams = [langid._grams(codes, lengths, n) for n in range(1, langid.ORDER + 1)]
    p = np.exp(-counts.cost(codes, lengths, grams))
    following = p[np.cumsum(lengths) - 2]  # the third letter after " ab"
    assert following.sum() + (langid.ALPHABET - 7) / langid.ALPHABET * 0.05 == pytest.approx(1, abs=0.05)


def test_kneser_ney_against_the_definition():
    """Every character's probability by the recursive formula over plain dictionaries."""
    words = {"ab": 3, "abc": 2, "bca": 1, "cab": 5, "abab": 2}
    order, d = langid.ORDER, langid.DISCOUNT
    raw = collections.Counter()
    for w, times in words.items():
        x = f" {w} "
        for n in range(1, order + 1):
            for i in range(max(1, n - 1), len(x)):
                raw[x[i - n + 1 : i + 1]] += times
    count = dict(raw)
    for g in raw:
        if len(g) < order:
            before = {h[0] for h in raw if len(h) == len(g) + 1 and h[1:] == g}
            count[g] = len(before) or raw[g]  # continuation counts; a word's beginning has nothing before it

    def probability(context, c):
        lower = probability(context[1:], c) if context else 1 / langid.ALPHABET
        following = {g: n for g, n in count.items() if len(g) == len(context) + 1 and g[:-1] == context}
        if not following:
            return lower
        total = sum(following.values())
        return max(following.get(context + c, 0) - d, 0) / total + min(d * len(following) / total, 1) * lower

    model = langid.Counts(list(words), np.array(list(words.values())))
    for w in ["ab", "abcab", "zab", "a", "cabbage"]:
        codes, lengths = langid.flat_codes([w], " ", " ")
        got = np.exp(-model.cost(codes, lengths, [langid._grams(codes, lengths, n) for n in range(1, order + 1)]))
        x = f" {w} "
        want = [probability(x[max(0, i - order + 1) : i], x[i]) for i in range(1, len(x))]
        assert got[1:] == pytest.approx(want, rel=1e-9)


def test_language_held_out(spark, docs):
    rng = random.Random(4)
    rows = [(i, " ".join("".join(rng.choices("aeiolmnr" if i % 2 else "kstwzhjg", k=5)) for _ in range(12)), "xx" if i % 2 else "yy", "s", 0) for i in range(300)]
    model = langid.train(spark.createDataFrame(rows, SCHEMA))
    got = langid.predict(spark.createDataFrame([*rows, (1000, None, "xx", "s", 0), (1001, "12 34!", "xx", "s", 0), (1002, "²½ Ⅷ ③", "xx", "s", 0), (1003, "", "xx", "s", 0)], SCHEMA), model).collect()
    for r in got:
        assert 0 <= r.score <= 1
        assert r.lang_pred == ("und" if r.doc_id >= 1000 else "xx" if r.doc_id % 2 else "yy")
    assert langid.predict(docs, langid.train(docs)).count() == docs.count()


def test_more_languages_than_texts(spark, monkeypatch):
    monkeypatch.setattr(langid, "ALL_TEXTS", 5)
    df = spark.createDataFrame([(i, f"word{i}", f"l{i % 9}", "s", 0) for i in range(90)], SCHEMA)
    assert langid.train(df).languages == ["l0", "l1", "l2", "l3", "l4"]


@pytest.mark.parametrize("rows", [0, 1, 20])
def test_odd_columns_and_empty_tables(spark, texts, rows):
    df = table(spark, texts[:rows], ODD) if rows else spark.createDataFrame([], ODD)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality_rules.keep(df).columns == df.columns and quality_rules.keep(df).count() <= rows
    assert line_dedup.dedup(df).columns == df.columns and line_dedup.dedup(df).count() == rows
    assert simhash.keep(df).columns == df.columns and simhash.keep(df).count() <= rows
    assert mixing.mix(df).columns == df.columns and mixing.mix(df).count() <= 2 * rows
    for out in (quality_rules.score(df), simhash.near_duplicates(df), mixing.taken(df), sharding.assign(df), media_audio.audio_features(df), toxicity.score(df, toxicity.train(df, labels)), line_crf.score(df, line_crf.train(df, labels)), langid.predict(df, langid.train(df))):
        assert out.count() == rows
    assert packing.pack(df, tokenizer_path()).count() >= rows


def test_copies_of_a_third_of_all_rows(spark, texts):
    df = spark.createDataFrame([(i, texts[0] if i % 3 else texts[i % 40], "en", "s", 0) for i in range(300)] + [(7, texts[0], "en", "s", 0)] * 100, SCHEMA)
    assert simhash.keep(df).count() == len(set(brute_components({brute_fingerprint(texts[i % 40]) for i in range(300)} | {brute_fingerprint(texts[0])}).values()))
    assert mixing.taken(df).count() == 400 and line_dedup.dedup(df).count() == 400 and sharding.assign(df, 2000).count() == 400


def brute_near_copies(texts):
    """Components of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more."""
    sets = []
    for t in texts:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    for j, i in itertools.combinations(range(len(texts)), 2):
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and root[i] != root[j]:
            root = [root[j] if r == root[i] else r for r in root]
    return root


@pytest.mark.parametrize("few", [near_copies.FEW, 1])
def test_near_copies_between_080_and_095(spark, monkeypatch, few):
    import corpus_pipeline

    monkeypatch.setattr(near_copies, "FEW", few)
    rng = random.Random(11)
    texts = []
    for _ in range(12):
        words = prose(rng, 300).split()
        texts.append(" ".join(words))
        for changes in (1, 4, 5, 6, 14, 20, 30):  # similarities from 0.97 down to below 0.4
            other = list(words)
            for k in range(changes):
                other[10 + k * (280 // changes)] = f"new{rng.random()}"
            texts.append(" ".join(other))
    texts += [texts[0].upper(), texts[8] + " end"]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    roots = brute_near_copies(texts)
    kept = [r.doc_id for r in corpus_pipeline.near(spark, df, "").collect()]
    assert sorted(kept) == sorted({roots.index(r) for r in roots})
    odd = spark.createDataFrame([], ODD)
    assert near_copies.keep(odd).columns == odd.columns and near_copies.keep(odd).count() == 0


def test_met_candidates_are_proposed_or_meet_again(spark):
    rng = np.random.default_rng(5)
    bits = np.concatenate([rng.random((1, 256)).repeat(n, 0) < 0.5 for n in (1, 2, 3, 5, 8, 13, 40)] * 3)
    bits ^= rng.random(bits.shape) < rng.choice([0.02, 0.05, 0.1, 0.13], (len(bits), 1))
    words = np.packbits(bits, axis=1).view(">u8").astype(np.uint64)
    sketch = np.concatenate([words, np.full((len(words), 1), 200, np.uint64)], axis=1)
    rows = [(i, i, row, True) for i, row in enumerate(sketch.view(np.int64).tolist())]
    told = [(r.a, r.b) for r in near_copies.proposals(spark.createDataFrame(rows, "node bigint, root bigint, sketch array<bigint>, asks boolean"), None).collect()]
    pairs, again = {t for t in told if t[1] is not None}, {a for a, b in told if b is None}
    assert len(pairs) < 3 * len(rows)

    seen = set()
    for values in near_copies.blocks_of(sketch).T:
        row, anchor, home = simhash.anchors(values)
        owners = collections.defaultdict(list)
        for x, at in zip(row[home].tolist(), anchor[home].tolist(), strict=True):
            owners[at].append(x)
        seen |= {(x, y) for y, at in zip(row.tolist(), anchor.tolist(), strict=True) for x in owners[at] if x != y}
    close = {(x, y) for x, y in seen if (bits[x] != bits[y]).sum() <= near_copies.RADII[near_copies.WORDS]}
    assert len(close) > 2000
    assert [p for p in close if (min(p), max(p)) not in pairs and not set(p) <= again] == []


def test_toxicity_scores_against_the_definition():
    rng = np.random.default_rng(0)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS), -0.3)

    def mixed(h):
        return int(toxicity.mix(np.array([h % (1 << 64)], np.uint64))[0]) % toxicity.BUCKETS

    def logit(word):
        codes = toxicity.flat_codes([word.strip("!*'#$%&-_+=/\\~`@^") or word], "<", ">")[0].tolist()
        buckets = []
        for n in toxicity.ORDERS:
            for i in range(len(codes) - n + 1):
                h = n
                for c in codes[i : i + n]:
                    h = (h * 0x100000001B3 + c) % (1 << 64)
                buckets.append(mixed(h))
        buckets.append(mixed(sum(c * pow(0x100000001B3, k + 1, 1 << 64) for k, c in enumerate(codes))))
        return np.mean(model.u[buckets])

    texts = ["You are *worthless*, truly!", "a", "", "one two, two three", "déjà-vu idi0t"]
    for text, got in zip(texts, model.scores(texts, model.table()), strict=True):
        words = toxicity.words_in(text)
        z = model.bias + toxicity.GAIN * (np.mean([logit(w) for w in words]) if words else 0)
        assert got == pytest.approx(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def test_crf_gradient():
    """The step's gradient is that of the chains' log-likelihood, by finite differences."""
    rng = np.random.default_rng(2)
    counts, width = np.array([3, 1, 4]), 3
    active = rng.integers(0, 6, (8, width))
    truth = np.repeat([1, 0, 1], counts)

    def likelihood(w, pair):
        unary, at, total = w[active].sum(1), 0, 0.0
        for n, y in zip(counts, (1, 0, 1)):
            scores = [sum(unary[at + k, z[k]] for k in range(n)) + sum(pair[a, b] for a, b in zip(z, z[1:])) for z in itertools.product((0, 1), repeat=int(n))]
            total += unary[at : at + n, y].sum() + (n - 1) * pair[y, y] - np.logaddexp.reduce(scores)
            at += n
        return total

    w, pair = rng.normal(size=(6, 2)), rng.normal(size=(2, 2))
    p, moves = line_crf.marginals(w[active].sum(1), pair, counts)
    gold = np.eye(2)[truth]
    g = np.stack([np.bincount(active.ravel(), np.repeat((gold - p)[:, k], width), 6) for k in range(2)], 1)
    stay = np.diag([0.0, 5.0])
    for i, k in itertools.product(range(6), range(2)):
        step = np.zeros((6, 2))
        step[i, k] = 1e-5
        assert (likelihood(w + step, pair) - likelihood(w - step, pair)) / 2e-5 == pytest.approx(g[i, k], abs=1e-6)
    for a, b in itertools.product(range(2), repeat=2):
        step = np.zeros((2, 2))
        step[a, b] = 1e-5
        assert (likelihood(w, pair + step) - likelihood(w, pair - step)) / 2e-5 == pytest.approx((stay - moves)[a, b], abs=1e-6)


def test_very_long_texts(spark):
    """Texts of 20,000 words, one of a single line of 200,000 characters without a blank."""
    rng = random.Random(13)
    long = [prose(rng, 20_000), "\n".join(prose(rng, 20) for _ in range(1000)), "x" * 200_000, prose(rng, 300)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(long)], SCHEMA)
    counts = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality_rules.score(df).collect()}
    assert counts == {i: expected_counts(t) for i, t in enumerate(long)}
    assert {r.doc_id: r.fingerprint for r in simhash.near_duplicates(df).collect()} == {i: f"{brute_fingerprint(t):016x}" for i, t in enumerate(long)}
    assert {r.doc_id: r.text for r in line_dedup.dedup(df).collect()} == dict(enumerate(long))
    assert {r.doc_id: r.n_bytes for r in media_audio.audio_features(df).collect()} == {i: len(t) for i, t in enumerate(long)}
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 1)], "doc_id bigint, quality int, toxic int")
    for out in (toxicity.score(df, toxicity.train(df, labels)), line_crf.score(df, line_crf.train(df, labels)), langid.predict(df, langid.train(df)), mixing.taken(df), sharding.assign(df, 100_000)):
        assert out.count() == 4
    pieces = packing.pack(df, tokenizer_path()).collect()
    assert all(sum(r.length for r in pieces if r.doc_id == i) == {r.doc_tokens for r in pieces if r.doc_id == i}.pop() for i in range(4))
