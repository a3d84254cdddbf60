"""The pipeline stage by stage on small inputs, and the registered queries against their SQL twins."""

import random
from collections import Counter
from pathlib import Path

import duckdb
import pytest
import xxhash

import __spark_entry__ as entry_point
import corpus_pipeline
from compare import differences
from contactflow.llm import queries

SCHEMA = "doc_id long, text string, lang string"
EN = "the of and to in that was for it with as his on be at by had not are but from or have an they which one you were her all she there would their we him been has when who will more no if out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over man me even most made after also did many before must through".split()
ES = "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy años hasta desde está mi porque qué sólo han yo hay vez puede todos así nos ni parte tiene él uno donde bien tiempo mismo ese ahora cada vida otro después te otros aunque esa eso hace".split()


def test_language_keeps_learned_languages_and_drops_others(spark):
    rng = random.Random(3)

    def words(vocabulary, n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    clean = [(i, words(EN if i % 2 else ES, rng.randint(2, 200)), "en" if i % 2 else "es") for i in range(200)]
    clean += [(200, "the", "en"), (201, words(EN, 60), None), (202, words(ES, 60), None), (None, words(ES, 60), "es")]
    clean += [(203, (words(EN, 100_000)), "en"), (clean[0][0], clean[0][1], None)]
    clean += [(205, words(EN, 12) + ' token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" 5755695738806562', "en")]
    finnish = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. "
    junk = "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(400))
    bad = [(300 + i, finnish * 2 + str(i), None) for i in range(40)] + [(400, "Съешь же ещё этих мягких булок " * 4, None)]
    bad += [(401, junk, None), (402, None, "en"), (403, "12 34 !!", "en"), (404, junk * 700, None)]
    got = corpus_pipeline.language(spark, spark.createDataFrame(clean + bad, SCHEMA), "")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(clean, key=str)
    assert corpus_pipeline.language(spark, spark.createDataFrame([], SCHEMA), "").count() == 0
    unlabelled = [(d, t, None) for d, t, _ in clean]
    assert corpus_pipeline.language(spark, spark.createDataFrame(unlabelled, SCHEMA), "").count() == len(clean)


def prints_of(text):
    """SimHash of a text, by brute force."""
    words = text.encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("small", [corpus_pipeline.SMALL_KEYS, 0])
def test_run_against_brute_force_stage_by_stage(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(corpus_pipeline, "SMALL_KEYS", small)
    rng = random.Random(5)
    texts = [(i, " ".join(rng.choice(EN if i % 3 else ES) for _ in range(rng.randint(40, 120))), "en" if i % 3 else "es") for i in range(40)]
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [*texts, (50, texts[7][1].replace(" ", "  \n"), "en"), (51, texts[7][1], "en"), (52, texts[8][1] + " " + item, "en"), (53, None, "en"), (54, "1 2 3", "es")]
    rows += [(60 + i, "Съешь же ещё этих мягких булок " * 3, None) for i in range(3)]
    long = " ".join(rng.choice(EN) for _ in range(3000))
    rows += [(70, long, "en"), (71, long + " the", "en"), (72, "Of " + long, "en")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, "no such words in here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    want, left = {}, [r for r in rows if r[1] and r[0] != 54 and not 60 <= r[0] < 63]
    want["language_id"] = left
    first = {}
    for d, t, _ in left:
        key = " ".join(t.split())
        first[key] = min(first.get(key, d), d)
    want["exact_dedup"] = left = [r for r in left if first[" ".join(r[1].split())] == r[0]]
    prints, least = [prints_of(t) for _, t, _ in left], [d for d, _, _ in left]
    for _ in left:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 2:
                    least[i] = least[j] = min(least[i], least[j])
    want["simhash_near_dedup"] = left = [r for r, n in zip(left, least, strict=True) if r[0] == n]
    want["benchmark_decontamination"] = [r for r in left if item not in r[1]]

    got, write = {}, corpus_pipeline.materialize

    def record(session, df, name):
        out = write(session, df, name)
        if name in want:
            got[name] = sorted(map(tuple, out.collect()))
        return out

    monkeypatch.setattr(corpus_pipeline, "materialize", record)
    drawn = Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == {name: sorted(kept) for name, kept in want.items()}
    assert set(drawn) == {d for d, _, _ in want["benchmark_decontamination"]}
    assert len(want["simhash_near_dedup"]) < len(want["exact_dedup"]) < len(want["language_id"])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_registered_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    assert differences(entry_point.queries()[name](spark, sf_dir), con, queries.ORACLES[name]) is None
