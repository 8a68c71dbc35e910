import json

from shoal.operators import logs, visitors


def _raw(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "seq long, value string")


def test_dirty_split_edge_texts(spark):
    good = json.dumps({"common": {"mid": "m1"}, "ts": 1})
    other_kinds = json.dumps({"common": {"mid": 7, "is_new": 1}, "err": {"error_code": "E12"}, "displays": {},
                              "page": "p", "ts": "5"})
    values = [good, "[1]", "{bad", '"x"', "", None, '{"a":1}', '{"common": 5}',
              json.dumps({"common": {"is_new": "1"}, "ts": 2}), json.dumps({"common": {"mid": "m"}}),
              json.dumps({"common": {"mid": "m"}, "ts": "soon"}), other_kinds]
    clean, dirty = logs.split_dirty(_raw(spark, values))
    # fields of another kind than the jobs expect make no record dirty
    assert sorted((r["seq"], r["mid"], r["is_new"], r["ts"]) for r in clean.collect()) == [
        (0, "m1", None, 1), (11, "7", "1", 5)]
    # no object / no common / no mid / no time -> dirty
    assert sorted(r["seq"] for r in dirty.collect()) == list(range(1, 11))


def _split(spark, records):
    clean, _ = logs.split_dirty(_raw(spark, [json.dumps(r) for r in records]))
    return {k: {r["seq"]: r for r in v.selectExpr("*", "to_json(record) text").collect()}
            if k in ("error", "start", "page") else
            [(r["seq"], json.loads(r["text"])) for r in v.selectExpr("seq", "to_json(record) text").collect()]
            for k, v in logs.split_log(clean).items()}


def test_split_log_cases(spark):
    c = {"mid": "m1", "is_new": "1", "ba": "phone", "deep": {"a": [1, {"b": None}]}}
    recs = [
        {"common": c, "err": {"error_code": 1}, "start": {"entry": "icon"}, "ts": 1, "more": 1.25},   # err+start
        {"common": c, "page": {"page_id": "p", "item": "x"}, "err": {"error_code": "E2"},
         "displays": [{"item": "a", "pos_id": 4}, {"item": "b"}], "ts": 2},                           # err+displays
        {"common": c, "page": {"page_id": "q"}, "displays": [], "ts": 3, "err": None},                # empty list
        {"common": c, "actions": [{"action_id": "x", "ts": 9}], "ts": 4},                             # no page
    ]
    out = _split(spark, recs)

    def text(route, seq):
        return json.loads(out[route][seq]["text"])

    assert sorted(out["error"]) == [0, 1] and text("error", 0) == recs[0] and text("error", 1) == recs[1]
    assert list(out["start"]) == [0]
    assert text("start", 0) == {k: v for k, v in recs[0].items() if k != "err"}
    assert sorted(out["page"]) == [1, 2, 3]
    assert text("page", 1) == {"common": c, "page": recs[1]["page"], "ts": 2}
    assert text("page", 2) == {"common": c, "page": recs[2]["page"], "ts": 3}
    assert text("page", 3) == {"common": c, "ts": 4}
    assert sorted(out["display"], key=str) == sorted(
        [(1, {"common": c, "page": recs[1]["page"], "ts": 2, "display": d}) for d in recs[1]["displays"]], key=str)
    assert out["action"] == [(3, {"common": c, "action": recs[3]["actions"][0]})]


def test_repaired_flag_reaches_every_output(spark):
    day = 86_400_000
    recs = [{"common": {"mid": "m", "is_new": "1", "n": 1}, "page": {}, "ts": day * 10},
            {"common": {"mid": "m", "is_new": "1", "n": 2}, "page": {}, "displays": [{"i": 1}], "ts": day * 12}]
    clean, _ = logs.split_dirty(_raw(spark, [json.dumps(r) for r in recs]))
    routed = logs.route_log(visitors.fix_is_new(clean)).collect()
    flags = sorted((r.route, json.loads(r.value)["common"]["n"], json.loads(r.value)["common"]["is_new"], r.mid) for r in routed)
    assert flags == [("display", 2, "0", "m"), ("page", 1, "1", "m"), ("page", 2, "0", "m")]


def test_route_log_one_pass(spark):
    c = {"mid": "m1", "is_new": "1"}
    recs = [{"common": c, "err": {"error_code": 1}, "start": {"entry": "icon"}, "ts": 1},
            {"common": c, "page": {"page_id": "p"}, "displays": [{"item": "a"}],
             "actions": [{"action_id": "x"}], "ts": 2}]
    clean, _ = logs.split_dirty(_raw(spark, [json.dumps(r) for r in recs]))
    routes = sorted(r["route"] for r in logs.route_log(clean).collect())
    assert routes == ["action", "display", "error", "page", "start"]


def test_text_is_parsed_once_per_row(spark, tmp_path):
    path = str(tmp_path / "raw")
    _raw(spark, ["{}"]).write.parquet(path)
    clean, dirty = logs.split_dirty(spark.read.parquet(path))
    for df in (dirty, logs.split_log(clean)["page"], logs.route_log(clean)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson(") == 1, plan
