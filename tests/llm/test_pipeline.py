import random
import re

import corpus_pipeline as C
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_stages_keep_clean_documents_and_drop_the_rest(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    before, kept = set(texts), {}
    current = docs
    for name, stage in C.STAGES:
        current = stage(spark, current, SF)
        if name != C.STAGES[-1][0]:
            assert current.columns == docs.columns
        current = C.materialize(current, "test-stage")
        kept[name] = {r.doc_id for r in current.select("doc_id").collect()}
        assert kept[name] <= before
        before = kept[name]
    good = {d for d, q in labels.items() if q == 1 and len(texts[d].split()) >= 20}
    assert len(good & kept["quality_rules"]) >= 0.98 * len(good)
    assert len(kept["language_id"]) >= 0.99 * len(kept["quality_rules"])
    by_text = {}
    for d in kept["language_id"]:
        by_text.setdefault(texts[d], []).append(d)
    for copies in by_text.values():
        assert len(set(copies) & kept["near_dedup"]) <= 1
    flat = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    leaking = {d for d in kept["near_dedup"] if any(flat(i) in flat(texts[d]) for i in items)}
    assert leaking and kept["decontamination"] == kept["near_dedup"] - leaking
    assert kept["sentencepiece"] == kept["decontamination"]


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string"
    text = "the words of this text are many and they are all of them in the same language so it goes on and on for long"
    rows = [(1, text), (1, text), (None, text + " x"), (2, None), (3, ""), (4, text + " zz qq" * 20)]
    docs = spark.createDataFrame([(*r, "en", None, None, "r", "k") for r in rows], schema)
    deduped = C.near_dedup(spark, docs, SF)
    # The row without doc_id is a near copy of row 1 and takes part.
    assert sorted(r.doc_id or 0 for r in deduped.collect()) == [1, 2, 3, 4] and deduped.columns == docs.columns
    language = C.language(spark, docs, SF)
    assert sorted(r.doc_id or 0 for r in language.collect()) == [0, 1, 1, 4] and language.columns == docs.columns
    assert C.decontaminate(spark, docs, SF).count() == 6
    assert C.quality_rules(spark, docs, SF).columns == docs.columns
    for name, stage in C.STAGES:
        assert stage(spark, docs.where(F.lit(False)), SF).collect() == [], name


def test_near_dedup_stage_is_brute_force(spark):
    from test_near_dedup import brute_force

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute_force([(r.doc_id, r.text) for r in docs.collect()], 5, 80, 100)
    kept = C.near_dedup(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in kept) == sorted(d for d, (_, c) in want.items() if c == d)
    # An id with two texts is two rows, and rows without id are told apart by their texts.
    twice = docs.unionAll(docs.withColumns({"doc_id": F.col("doc_id") % 3, "text": F.concat("text", F.lit(" "), F.md5("text"), F.lit(" of its own"))}))
    twice = twice.unionAll(docs.withColumn("doc_id", F.lit(None).cast("long")))
    rows = C.near_dedup(spark, twice, SF).collect()
    sets = {tuple(sorted(set(zip(*[r.text.lower().split()[k:] for k in range(5)])) or [tuple(r.text.lower().split())])) for r in rows if r.text}
    assert len(sets) == sum(bool(r.text) for r in rows) and not any(r.doc_id is None for r in rows)


FOREIGN = [
    "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita, e oggi andiamo tutti insieme al mare",
    "Todos os seres humanos nascem livres e iguais em dignidade e em direitos e devem agir uns para com os outros em espírito de fraternidade",
    "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren en behoren zich jegens elkander in een geest van broederschap te gedragen",
    "Litwo, ojczyzno moja, ty jesteś jak zdrowie; ile cię trzeba cenić, ten tylko się dowie, kto cię stracił",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan, ja heille on annettu järki ja omatunto",
    "Все люди рождаются свободными и равными в своем достоинстве и правах, они наделены разумом и совестью",
    "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα",
]


def test_language_stage_drops_gibberish_and_other_languages_and_keeps_the_rest(spark):
    rnd = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    gibberish = [" ".join("".join(rnd.choices(letters, k=rnd.randint(2, 9))) for _ in range(n)) for n in (20, 40, 100, 400) * 5]
    docs = C.materialize(C.quality_rules(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF), "test-clean")
    planted = spark.createDataFrame([(-1 - k, t, None, "planted", len(t)) for k, t in enumerate(gibberish + FOREIGN)], docs.schema)
    clean = {r.doc_id for r in docs.collect()}
    kept = {r.doc_id for r in C.language(spark, docs.unionAll(planted), SF).collect()}
    assert not any(d < 0 for d in kept)
    assert len(kept) >= 0.995 * len(clean)


def test_least_language_score_lies_above_chance():
    assert C.least_language_score(4) == 0.625 and C.least_language_score(1) == 1
    assert all(C.least_language_score(n) >= 1 / n + 0.25 for n in range(2, 200))
