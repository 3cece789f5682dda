"""The pipeline, stage by stage, over a small table with nulls, empty texts, repeats and clashing columns."""

import collections
import os
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from test_operators import SCHEMA, WORD, brute_lines, brute_near_copies, prose

import corpus_pipeline
from spanforge.llm import common, line_dedup, mixing, sql
from spanforge.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    block = "\n".join(prose(rng, 15) for _ in range(5))  # 75 words that repeat across documents
    texts = [prose(rng, 120) for _ in range(60)] + [prose(rng, 40) + "\n" + block + "\n" + prose(rng, 40) for _ in range(6)]
    near = prose(rng, 200).split()
    for k in range(4):
        texts.append(" ".join([*near[: 50 * k], f"changed{k}", *near[50 * k :]]))
    texts += [None, "", " \n ", "too short", " ".join(f"{w}$$$" for w in prose(rng, 100).split()), "again and again " * 60]
    out = [(i, t, None if i % 13 == 12 else "en", None if i % 11 == 10 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    out += [(200 + i, out[i][1], "en", "s1", 0) for i in range(5)] + [out[3], out[3], (None, texts[9], "en", "s0", 0), (None, None, None, None, 0)]
    return out


def key(r):
    return r.doc_id, r.text, r.lang, r.source, r.n_chars, r.shard


def test_stages_against_brute_force(spark, rows, tmp_path):
    os.makedirs(tmp_path / "sf")
    spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", shard string").repartition(3).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "sf" / "documents.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mixing", "packing"]
    held = [collections.Counter(map(key, docs.collect()))]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        held.append(collections.Counter(map(key, docs.collect())))
    start, ruled, lined, single, mixed = held

    # rules: the same verdicts as the SQL's, and all columns as they were
    con = duckdb.connect()
    flat = list(start.elements())
    con.register("documents", pd.DataFrame(flat, columns=["doc_id", "text", "lang", "source", "n_chars", "shard"]).astype({"doc_id": "Int64"}))
    verdicts = con.execute(sql.ORACLE_SQL["op1_quality_rules"]).fetchall()
    assert collections.Counter(v[0] for v in verdicts if v[7]) == collections.Counter(r[0] for r in ruled.elements())
    assert not ruled - start and any("$$$" in (r[1] or "") for r in (start - ruled).elements())

    # lines: later copies of runs are gone, nothing else changes
    gone = brute_lines([(r[0], r[1]) for r in ruled], line_dedup.MIN_WORDS)
    cut = lambda r: (r[0], "\n".join(x for at, x in enumerate(r[1].split("\n")) if at not in gone[(r[0], r[1])]), *r[2:])
    want = collections.Counter()
    for r, n in ruled.items():
        want[cut(r)] += n
    assert lined == want and lined != ruled

    # near copies: one document of each component of all pairs, the one with the smallest id
    members = sorted(lined, key=lambda r: (r[0] is None, r[0] or 0))
    roots = brute_near_copies([r[1] for r in members])
    assert collections.Counter(r[0] for r in single.elements()) == collections.Counter(members[roots.index(x)][0] for x in dict.fromkeys(roots))
    assert max(single.values()) == 1 and not single - lined

    # mixture: documents as they were, as often as the plan of this table takes them
    table = spark.createDataFrame(list(single), SCHEMA + ", shard string")
    copies = {r.doc_id: r.copies for r in mixing.taken(table).collect()}
    assert {r[0]: n for r, n in mixed.items()} == {i: n for i, n in copies.items() if n}

    # packing: every id once, windows full or of a power of two
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(tokenizer_path())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    ids = collections.Counter()
    for r, n in mixed.items():
        ids[(r[0], tuple(tokens.encode(r[1] or "", add_special_tokens=False).ids + [2]))] += n
    assert sum(p.length for p in pieces) == sum(len(x) * n for (_, x), n in ids.items())
    for (doc, x), _ in ids.items():
        own = {p.start: p for p in pieces if p.doc_id == doc}
        assert all(p.ids_crc32 == zlib.crc32(np.array(x[s : s + p.length], "<u4").tobytes()) for s, p in own.items())
    filled = collections.Counter()
    for p in pieces:
        filled[p.sequence_id] += p.length
    assert all(f == 4096 or f & (f - 1) == 0 for f in filled.values())

    # run: the same stages; of their tables only the last one is left
    whole = corpus_pipeline.run(spark, str(tmp_path / "sf"))
    assert sum(r.length for r in whole.collect()) == sum(p.length for p in pieces)


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_no_checkpoint_folder_of_one_machine(monkeypatch):
    """Without a shared folder a cluster session is refused."""

    class Nothing:
        master = "spark://somewhere:7077"

        def getConf(self):
            return {}

        def sc(self):
            return self

        def getCheckpointDir(self):
            return self

        def isDefined(self):
            return False

        def get(self, name, default=None):
            return default

    session = Nothing()
    session.sparkContext = session.conf = session._jsc = session
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.checkpoint_dir(session)
