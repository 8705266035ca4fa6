import glob
import os

from corpusmill.plans import queries


def test_each_listed_file_is_written_by_a_task_of_its_own(spark, folder):
    spark.range(40).selectExpr("id AS doc_id", "concat('text ', id) AS text").write.parquet(f"{folder}/documents.parquet")
    _, mirror = queries._stored_manifest(spark, folder)
    written = glob.glob(next(iter(mirror.values())).replace("file://", "").replace("file:", "") + "/n=*/part-*.gz")
    assert len(written) == 4
    assert len({os.path.basename(path).split("-")[1] for path in written}) == 4
