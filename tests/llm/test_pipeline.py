"""The pipeline against brute force on the small table; optional registration."""
import hashlib
import os
import subprocess
import sys
from collections import Counter, defaultdict

import corpus_pipeline as P
import __spark_entry__ as E
from test_dedup import LOWER, brute_components, shingles
from test_mix_and_shards import rounds, words
from wattline.llm.pieces import read_model


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def brute_mix(docs, seed=0):
    by = defaultdict(list)
    for r in docs:
        by[r["source"]].append((hashlib.md5(f"{seed}:{r['doc_id']}".encode()).hexdigest(), r["doc_id"], words(r["text"])))
    sizes = {s: sum(n for *_, n in own) for s, own in by.items()}
    out = Counter()
    for s, target in rounds(sizes).items():
        whole, rest = divmod(int(target + 0.5), sizes[s]) if sizes[s] else (0, 0)
        for _, i, n in sorted(by[s]):
            extra, rest = min(n, rest), rest - min(n, rest)
            out[i] += int((whole * n + extra) / n + 0.5) if n else 0
    return +out


def test_each_stage_on_what_the_one_before_kept(spark, sf_dir, tmp_path):
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "source_mix", "sentencepiece"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before, kept = docs.columns, rows_of(docs), {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = rows_of(docs)
        if name != "sentencepiece":
            assert docs.columns == columns
    ids = {n: Counter(r["doc_id"] for r in rows) for n, rows in kept.items()}
    assert ids["language_id"] == Counter(r["doc_id"] for r in before if any(c.isalpha() for c in r["text"] or ""))
    from wattline.llm import lang_id
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    told = {r["doc_id"]: r["lang_pred"] for r in lang_id.identify(table, lang_id.fit(table)).collect()}
    assert all(r["lang"] == told[r["doc_id"]] for r in kept["language_id"])
    groups = defaultdict(list)
    for r in kept["language_id"]:
        groups[r["text"].translate(LOWER)].append(r["doc_id"])
    assert ids["exact_dedup"] == Counter(max(g) for g in groups.values())
    pairs = [(r["doc_id"], r["text"]) for r in kept["exact_dedup"]]
    assert ids["jaccard_join"] == Counter({int(c) for _, _, c in brute_components(pairs)})
    assert all(shingles(t) for _, t in pairs)
    assert ids["source_mix"] == brute_mix(kept["jaccard_join"])
    from sentencepiece import SentencePieceProcessor
    library = SentencePieceProcessor(model_proto=read_model(None))
    text = {r["doc_id"]: r["text"] for r in kept["source_mix"]}
    assert ids["sentencepiece"] == ids["source_mix"]
    assert all(r["ids"] == library.encode(text[r["doc_id"]]) and r["n_tokens"] == len(r["ids"]) for r in kept["sentencepiece"])


def test_run_on_an_empty_table(spark, table, tmp_path):
    table([]).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_stages_on_odd_rows(spark, table, odd_rows):
    docs = table(odd_rows)
    for _, stage in P.STAGES:
        out = stage(spark, docs, None)
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert docs.columns == ["doc_id", "n_tokens", "ids"]


def test_queries_are_registered_and_optional():
    names = [n for n in E.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
    code = ("import sys; sys.modules['wattline.llm'] = None; import __spark_entry__ as E; "
            "assert len(E.queries()) > 100 and set(E.oracle_sql()) <= set(E.queries()) and 'pipeline' not in E.queries()")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(E.__file__))
