"""Change records are parsed once per text."""

from decimal import Decimal

from txnlake.sources import cdc


def test_a_record_is_parsed_once(spark):
    body = '{"id":"7","status":"S","amount":"1.5"}'
    rows = [("k", body, "u"), ('{"id":"8"}', None, "d"), ("k", f'{{"payload":{body}}}', None), ("k", "[1]", "u")]
    records = spark.createDataFrame([(k, v, [("op", op)] if op else None, 0, n) for n, (k, v, op) in enumerate(rows)],
                                    cdc.RECORD_SCHEMA)
    out = cdc.decode_rows(records, cdc.TABLES["transactions"])
    assert [tuple(r) for r in out.select("_offset", "op", "id", "amount").orderBy("_offset").collect()] == [
        (0, "u", "7", Decimal("1.500000")), (1, "d", "8", None), (2, "c", "7", Decimal("1.500000"))]
    # value, its payload, key, its payload
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 4
