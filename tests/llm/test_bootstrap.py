"""Contexts that grow from found instances, and identifiers withheld from the base patterns."""

from pyspark.sql import functions as F

from corpusmill.llm import pii, queries


def more(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.personal_data(docs, "doc_id", "text").collect()
    return {texts[r["id"]][s["start"] : s["end"]] for r in found for s in r["more"]}


def test_found_instances_bring_in_patterns(spark):
    base = [f"mail to jane.{k}@mail.example.org now" for k in range(40)]
    # Handles stand where mail addresses stand, and in a second context that no base match has.
    both = [t for k in range(8) for t in (f"mail to handle_{k}q now", f"account named handle_{k}q here")]
    only = ["account named far_away_one here", "account named far_away_two here", "a list of far_off_name here"]
    found = more(spark, [*base, *both, *only])
    assert found == {*(f"handle_{k}q" for k in range(8)), "far_away_one", "far_away_two"}


def test_contexts_with_few_seeds_say_nothing(spark):
    assert more(spark, ["mail to a@b.org now", "mail to c@d.org now", "mail to some_handle now"]) == set()
    assert more(spark, ["plain words only", "", "x_y"]) == set()


def test_withheld_base_matches_are_found_again(spark):
    """A fifth of the base matches lose their kind; their contexts bring some of them back."""
    docs = queries.read(spark, "/root/testdata/sf0.1", "documents")
    scanned = pii.scan(docs, "doc_id", "text")
    withheld = F.pmod(F.xxhash64("instance"), F.lit(5)) == 0
    hidden = F.transform(
        "tokens",
        lambda t: t.withField("kind", F.when(F.pmod(F.xxhash64(t["instance"]), F.lit(5)) != 0, t["kind"])),
    )
    known = scanned.select(F.explode("tokens").alias("t")).select("t.*")
    gone = known.where(F.col("kind").isNotNull() & withheld).select("instance").distinct()
    found = pii.confident_instances(scanned.withColumn("tokens", hidden))
    total, back = gone.count(), gone.join(found, "instance").count()
    # The words around the identifiers of this table are random; a fifth comes back.
    assert total > 100 and back >= 0.15 * total
