import json

import pytest

from skyfold.operators.flatten import flatten_alert, flatten_forecast
from skyfold.sources import schemas as S
from skyfold.sources.readers import parse_documents


def docs(spark, payloads, schema):
    rows = [("b1", json.dumps(p)) for p in payloads]
    return parse_documents(spark.createDataFrame(rows, "batch_id string, body string"), schema)


def slot(t, v, unit="C"):
    return {"startTime": t, "endTime": t, "parameter": {"parameterName": v, "parameterUnit": unit}}


def test_forecast_keeps_only_mapped_codes(spark):
    p = {"records": {"location": [
        {"locationName": "AAA", "weatherElement": [
            {"elementName": "MinT", "time": [slot("2026-06-03 06:00:00", "20"),
                                             slot("2026-06-03 18:00:00", "21")]},
            {"elementName": "Wx", "time": [slot("2026-06-03 06:00:00", "Cloudy")]},
            {"elementName": "MaxT", "time": [slot("2026-06-03 06:00:00", "30")]},
            {"elementName": "MaxT", "time": []}]},
        {"locationName": "BBB", "weatherElement": []}]}}
    rows = flatten_forecast(docs(spark, [p], S.BRONZE_FORECAST)).collect()
    assert sorted((r.City, r.Type, r.Temp) for r in rows) == [
        ("AAA", "HighestTemp", "30"), ("AAA", "LowestTemp", "20"), ("AAA", "LowestTemp", "21")]
    assert rows[0].batch_id == "b1"


def test_forecast_empty_location_no_rows(spark):
    assert flatten_forecast(docs(spark, [{"records": {"location": []}}],
                                 S.BRONZE_FORECAST)).count() == 0


def test_forecast_missing_location_fails(spark):
    with pytest.raises(Exception, match="raw document without records.location"):
        flatten_forecast(docs(spark, [{"records": {}}], S.BRONZE_FORECAST)).collect()


def info(area, params, event="Heat"):
    return {"onset": "2026-06-03T10:00:00+08:00", "expires": "2026-06-03T17:00:00+08:00",
            "event": event, "parameter": params, "area": area}


def test_alert_last_criteria_wins_and_null_areas_skipped(spark):
    crit = lambda v: {"valueName": "alert_criteria", "value": v}
    p = {"records": {"info": [
        info([None, {"areaDesc": "臺北市信義區"}, {"areaDesc": "臺北市大安區"}],
             [crit("yellow"), {"valueName": "x", "value": "y"}, crit("orange")]),
        info([{"areaDesc": "高雄市"}], []),
        info([], [crit("red")])]}}
    rows = flatten_alert(docs(spark, [p], S.BRONZE_ALERT)).collect()
    got = sorted((r.area, r.level) for r in rows)
    assert got == [("臺北市信義區", "orange"), ("臺北市大安區", "orange"), ("高雄市", None)]


def test_alert_empty_info_is_zero_rows_not_error(spark):
    assert flatten_alert(docs(spark, [{"records": {"info": []}}], S.BRONZE_ALERT)).count() == 0
