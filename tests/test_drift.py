from __future__ import annotations

import json
import random

from tidemark.operators import drift

SCHEMA = "file_id bigint, producer string, file_seq int, event_date date, body string, field string, name string"
KINDS = {"text": "x", "whole": 3, "fraction": 2.5, "truth": True, "object": {"a": 1}, None: None}


def files(spark, rows):
    return spark.createDataFrame([(i, p, s, None, b, "clash", None) for i, p, s, b in rows], SCHEMA)


def brute(rows):
    names = {"customer_name": "customer", "eventTime": "event_time", "Customer": "customer", "biz_version": "business_version"}
    out, state, kinds = set(), {}, {}
    for fid, producer, _, body in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[2])):
        seen = {}
        readable = False
        for line in (body or "").split("\n"):
            try:
                record = json.loads(line)
            except ValueError:
                continue
            readable = True
            for k, v in record.items():
                field = names.get(k, k)
                kind = next(n for n, e in KINDS.items() if type(e) is type(v))
                seen[field] = (k, kind or seen.get(field, (0, None))[1])
        if not readable:
            continue
        before = state.get(producer)
        if before is not None:
            out |= {(fid, f, "added") for f in seen.keys() - before.keys()} | {(fid, f, "removed") for f in before.keys() - seen.keys()}
            for f in seen.keys() & before.keys():
                if seen[f][0] != before[f][0]:
                    out.add((fid, f, "renamed"))
                known = kinds.get((producer, f))
                if seen[f][1] and known and seen[f][1] != known:
                    out.add((fid, f, "retyped"))
        kinds |= {(producer, f): k for f, (_, k) in seen.items() if k}
        state[producer] = seen
    return out


def random_files(seed, n):
    rng = random.Random(seed)
    rows = []
    for p in ("a", "b"):
        names = {"customer": "customer", "event_time": "event_time", "business_version": "business_version", "x": "x"}
        kinds = dict.fromkeys(names, "text")
        for s in range(n):
            if rng.random() < 0.3:
                f = rng.choice(list(names))
                kinds[f] = rng.choice(["text", "whole", "fraction", "truth", "object"])
            if rng.random() < 0.3:
                names["customer"] = rng.choice(["customer", "customer_name", "Customer"])
                names["business_version"] = rng.choice(["business_version", "biz_version"])
            there = [f for f in names if rng.random() < 0.85]
            nulls = [f for f in there if rng.random() < 0.2]
            lines = [json.dumps({names[f]: None if f in nulls else KINDS[kinds[f]] for f in there}) for _ in range(rng.randrange(3))]
            if rng.random() < 0.2:
                lines.append('{"cut": "of')
            rows.append((len(rows), p, s, "\n".join(lines)))
    rows.append((len(rows), None, None, '{"q":1}'))
    rng.shuffle(rows)
    return rows


def test_changes_against_brute_force_for_any_block(spark, tmp_path):
    rows = random_files(5, 40)
    for block in (1, 3, 7, 4096):
        got = [tuple(r) for r in drift.find_changes(spark, files(spark, rows), str(tmp_path / f"b{block}"), block).collect()]
        assert set(got) == brute(rows), block
        assert len(got) == len(set(got))


def test_kinds(spark):
    body = '{"a":1,"b":2.0,"c":"1","d":true,"e":{"x":1},"f":null,"g":[1],"h":123456789012345678901234,"i":1e3}'
    shape = drift.file_shapes(files(spark, [(1, "p", 1, body)])).first()
    assert {f.name: f.kind for f in shape.fields} == {"a": "whole", "b": "fraction", "c": "text", "d": "truth", "e": "object", "f": None, "g": "array", "h": "whole", "i": "fraction"}


def test_renamed_and_retyped_at_once_and_unreadable(spark, tmp_path, rows_of):
    rows = [(1, "p", 1, '{"customer":"x"}'), (2, "p", 2, ""), (3, "p", 3, '{"customer":'), (4, "p", 4, '{"customer_name":5}'), (5, "p", 5, "{}"), (6, "p", 6, None)]
    got = rows_of(drift.find_changes(spark, files(spark, rows), str(tmp_path / "x")))
    assert got == [(4, "customer", "renamed"), (4, "customer", "retyped"), (5, "customer", "removed")]
    assert drift.find_changes(spark, files(spark, []), str(tmp_path / "y")).count() == 0


def test_ingest_rescues_and_promotes(spark):
    good = {"order_id": "o", "order_amount": "12.5", "biz_version": "3", "eventTime": 1426487229175, "sourceEpochId": 20150301, "payload_json": {"b": 1}, "channel": "web", "note": "z" * 100_000}
    bad = {"order_id": "p", "amount": "much", "business_version": 2.5, "event_time": "2015-03-01T20:50:14.368284+00:00", "channel": 7}
    body = json.dumps(good) + "\n" + json.dumps(bad) + '\n{"order_id": "cut'
    rows = {r.order_id: r for r in drift.ingest_files(files(spark, [(1, "p", 1, body), (2, "p", 2, "")])).collect()}
    assert set(rows) == {"o", "p"}
    o, p = rows["o"], rows["p"]
    assert (o.amount, o.business_version, o.source_epoch_id, o.canonical_payload, str(o.event_time)) == (12.5, 3, "epoch-2015-03-01", '{"b":1}', "2015-03-16 06:27:09.175000")
    assert set(json.loads(o.rescued)) == {"channel", "note"}
    assert json.loads(p.rescued) == {"amount": "much", "business_version": 2.5, "channel": 7}
    assert (p.amount, p.business_version, str(p.event_date)) == (None, None, "2015-03-01")
    promoted = {r.order_id: r for r in drift.promote(drift.ingest_files(files(spark, [(1, "p", 1, body)])), {"channel": "string", "note": "int"}).collect()}
    assert promoted["o"].channel == "web" and promoted["p"].channel == "7"
    assert set(json.loads(promoted["o"].rescued)) == {"note"}  # cannot be cast, stays


def test_promotion_fills_only_what_is_null(spark):
    rows = spark.createDataFrame([("a", 1.5, '{"amount":9.25,"x":1}'), ("b", 2.5, None), ("c", None, '{"amount":3.5,"x":2}'), ("d", None, '{"amount":"much"}'), ("e", 4.0, "no json")], "order_id string, amount double, rescued string")
    got = {r.order_id: (r.amount, r.x, r.rescued) for r in drift.promote(rows, {"amount": "double", "x": "int"}).collect()}
    assert got == {"a": (1.5, 1, '{"amount":9.25}'), "b": (2.5, None, None), "c": (3.5, 2, None), "d": (None, None, '{"amount":"much"}'), "e": (4.0, None, "no json")}


def test_unreadable_lines_are_rescued(spark):
    body = '{"order_id":"o"}\n\n{"order_id": "cut\n[1]\n'
    rows = drift.ingest_files(files(spark, [(1, "p", 1, body)]), unreadable=True).collect()
    assert [(r.line_no, r.order_id, r.rescued and json.loads(r.rescued)) for r in sorted(rows, key=lambda r: r.line_no)] == [(0, "o", None), (2, None, {"_unreadable": '{"order_id": "cut'}), (3, None, {"_unreadable": "[1]"})]


def test_unknown_names_are_inferred_from_the_payload(spark, tmp_path, rows_of):
    def record(i, **more):
        payload = {"order_id": f"o{i}", "customer": f"c{i % 7}", "amount": i + 0.5, "business_version": i % 3, "event_time": f"2015-03-01T10:00:{i:02d}+00:00"}
        return json.dumps({"order_id": f"o{i}", "canonical_payload": json.dumps(payload) if i % 2 else payload, **more})

    before = "\n".join(record(i, customer=f"c{i % 7}", amount=i + 0.5, event_time=1425204000000 + i * 1000) for i in range(10))
    after = "\n".join(record(i, kunde=f" c{i % 7}", betrag=str(i + 0.5), zeitpunkt=1425204000000 + i * 1000, priority=i % 2 + 5, note=f"c{i}") for i in range(10, 20))
    frame = files(spark, [(1, "p", 1, before), (2, "p", 2, after)])
    got = rows_of(drift.find_changes(spark, frame, str(tmp_path / "x")))
    assert got == [(2, "amount", "renamed"), (2, "amount", "retyped"), (2, "customer", "renamed"), (2, "event_time", "renamed"), (2, "note", "added"), (2, "priority", "added")]
    rows = drift.ingest(spark, frame, str(tmp_path / "y")).filter("file_id = 2").collect()
    assert {r.customer for r in rows} == {f" c{i % 7}" for i in range(10, 20)} and sum(r.amount for r in rows) == sum(i + 0.5 for i in range(10, 20))
    assert all(set(json.loads(r.rescued)) == {"priority", "note"} for r in rows)
    few = files(spark, [(1, "p", 1, before), (2, "p", 2, "\n".join(after.split("\n")[:4]))])  # too little evidence
    assert (2, "kunde", "added") in rows_of(drift.find_changes(spark, few, str(tmp_path / "z")))
