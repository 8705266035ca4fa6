import os

from corpusmill.functions.worker import worker_cache


def test_a_later_task_of_a_worker_finds_what_an_earlier_one_kept(spark):
    def seen(batches):
        import pandas as pd

        for batch in batches:
            kept = worker_cache("test_worker")
            kept["tasks"] = kept.get("tasks", 0) + 1
            yield pd.DataFrame({"pid": [os.getpid()], "tasks": [kept["tasks"]]})

    rows = spark.range(0, 40, 1, 40).mapInPandas(seen, "pid long, tasks long").collect()
    assert max(r["tasks"] for r in rows) > 1
    assert len({(r["pid"], r["tasks"]) for r in rows}) == len(rows)
