import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"


def test_entry_has_the_shards_of_every_source(spark):
    df = contract.entry(spark)
    assert df.columns == ["source_id", "shard_sequence", "size_bytes", "record_count", "last_pos", "checksum"]
    assert df.count() >= 1


def test_every_checked_query_is_registered():
    queries, checks = contract.queries(), contract.oracle_sql()
    assert set(checks) <= set(queries)
    own = set(queries) - set(contract.LLM_QUERIES)
    assert own - set(checks) == {"bpe_train", "corpus_encode", "encoded_blocks"}


def test_sql_gives_the_same_rows(spark):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "events", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    for name in ("shard_stats", "assemble_documents", "pack_blocks", "lifecycle_audit", "run_manifest"):
        rows = con.execute(contract.oracle_sql()[name])
        columns = [d[0] for d in rows.description]
        expected = sorted(map(str, rows.fetchall()))
        found = contract.queries()[name](spark, SF).select(*columns)
        assert sorted(str(tuple(r)) for r in found.collect()) == expected, name
