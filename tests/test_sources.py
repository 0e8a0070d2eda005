from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tallywright.functions import text
from tallywright.operators import profile
from tallywright.sources import catalog, raw, tables
from tallywright.plans import surveys
from tallywright.plans.budget_queries import REGISTRY
from tallywright.streaming import ingest


def test_decode_and_parse():
    body = "01会計,02款\r\n01一般会計,01議会費\r\n\r\n".encode("cp932")
    p = raw.verified(body, "cp932")
    assert p.header == ["01会計", "02款"] and p.rows == [["01一般会計", "01議会費"]] and raw.rebuild(p).encode("cp932") == body
    with pytest.raises(UnicodeDecodeError):
        raw.decode_reversible(b"\xff\xff\x81", "cp932")
    with pytest.raises(ValueError):
        raw.verified("a,b\n1\n".encode(), "utf-8")
    with pytest.raises(ValueError):
        raw.verified('a,b\n"1,2",3\n'.encode(), "utf-8")
    assert raw.decode_lenient("予算".encode("shift_jis")) == "予算" and raw.split_header('﻿a, "b,c" ') == ["a", "b,c"]


def test_ingest_is_idempotent(spark, tmp_path):
    body = "a,b\n1,\n2,x\n".encode()
    args = (spark, body, "utf-8", str(tmp_path), "011002", 2024, "approved", "expenditure")
    assert raw.ingest(*args) and not raw.ingest(*args)
    from pyspark.sql import types as T

    got = raw.read_raw(spark, str(tmp_path), T.StructType([T.StructField("source_row", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]), jurisdiction="011002")
    assert sorted(tuple(r) for r in got.select("source_row", "a", "b", "jurisdiction").collect()) == [(2, "1", "", "011002"), (3, "2", "x", "011002")]
    record = raw.read_provenance(spark, [raw.partition_path(str(tmp_path), "011002", 2024, "approved", "expenditure") + "/provenance.json"]).first()
    assert record.rows == 2 and record.roundtrip_verified and record.header == ["a", "b"]


def test_csv_keeps_blank_and_null(spark, tmp_path):
    df = spark.createDataFrame([(1, "", "01"), (2, None, 'q"x'), (3, "a,b", "\\n")], "k int, a string, b string")
    tables.write_csv_file(df, str(tmp_path / "x.csv"), ["k"])
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "x.csv"), df.schema).orderBy("k").collect()] == [tuple(r) for r in df.collect()]
    (tmp_path / "seed.csv").write_text("k,a\r\n01,\r\n02,x\r\n")
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "seed.csv"), "k string, a string", blank_is_null=True).orderBy("k").collect()] == [("01", None), ("02", "x")]


def test_catalog(spark, tmp_path):
    path = tmp_path / "sources.toml"
    path.write_text(REGISTRY)
    found = catalog.load_sources(str(path))
    source = catalog.resolve(found, "132047:2024")
    assert source.organization == "t132047" and [r.direction for r in source.resources] == ["expenditure", "revenue"] and not catalog.may_publish(source)
    for decision, may in (("allow", True), ("deny", False), ("review", False)):
        path.write_text(REGISTRY.replace('"review"', f'"{decision}"'))
        assert catalog.may_publish(catalog.load_sources(str(path))["132047:2024"]) == may
    with pytest.raises(KeyError):
        catalog.resolve(found, "x")
    for text_, error in ((REGISTRY.replace('catalog = "c"', 'catalog = "none"'), KeyError), ("", ValueError), (REGISTRY.replace('encoding = "cp932"\n', ""), ValueError)):
        path.write_text(text_)
        with pytest.raises(error):
            catalog.load_sources(str(path))
    pages_ = {0: {"count": 3, "results": [1, 2]}, 2: {"count": 3, "results": [3]}}
    assert list(catalog.all_results(pages_.__getitem__)) == [1, 2, 3]
    with pytest.raises(ValueError):
        list(catalog.all_results(lambda start: {"count": 3, "results": [1, 2] if not start else []}))
    packages = spark.createDataFrame([("o", "t", [("a", "u1"), ("b", "u2"), ("a", "u3")])], "organization string, title string, resources array<struct<name:string,url:string>>")
    assert [r.url for r in catalog.resolve_resource(packages, "o", "t", "a").collect()] == ["u1", "u3"] and catalog.resource_url(packages, "o", "t", "a") == "u1"
    for title, name in (("none", "a"), ("t", "none")):
        with pytest.raises(LookupError):
            catalog.resource_url(packages, "o", title, name)
    pages = spark.createDataFrame([("x", 1, "old"), ("x", 2, "new"), ("y", 1, "only")], "name string, position int, v string")
    assert {r.name: r.v for r in tables.last_by(pages, "name", "position").collect()} == {"x": "new", "y": "only"}
    m = spark.createDataFrame([({"13": ("n", 3)},)], "j map<string, struct<name:string, n:int>>")
    assert [tuple(r) for r in tables.exploded_map(m, "j").collect()] == [("13", "n", 3)]


def test_text_functions(spark):
    df = spark.createDataFrame([("０１款", "３目"), ("01_款(円)", "x")], "a string, b string")
    assert [r[0] for r in df.select(text.column_name(F.col("a"))).collect()] == ["款", "款"]
    one = spark.createDataFrame([(bytearray(b"%PDF-1.4"), "12", "１２", "令和６年度予算", 123_456_789, "a\nb\n\nc\n")], "c binary, d string, e string, t string, y bigint, s string")
    r = one.select(text.sniff(F.col("c")).alias("c"), text.is_code(F.col("d")).alias("d"), text.is_code(F.col("e")).alias("e"), text.has_era_label(F.col("t"), 2024).alias("t"), text.yen_short(F.col("y")).alias("y"), text.data_rows(F.col("s")).alias("s")).first()
    assert tuple(r) == ("pdf", True, False, True, "1.2億円", 2)
    assert [x[0] for x in spark.createDataFrame([("歳出予算",), ("歳入歳出",), ("歳入",)], "t string").select(text.direction_of(F.col("t"))).collect()] == ["expenditure", "unknown", "revenue"]
    assert text.era_labels(2019) == ["令和元年度"] and text.era_labels(2018) == ["平成30年度", "平成３０年度"] and text.era_labels(1989) == ["平成元年度"] and text.era_labels(1988)[0] == "昭和63年度"
    with pytest.raises(ValueError):
        text.era_labels(1900)
    amounts = [(0, "0円"), (-9_999, "-9,999円"), (12_345, "1万円"), (123_456_789, "1.2億円"), (-10_000_000_000, "-100億円"), (123_456_789_012, "1235億円")]
    assert [x[0] for x in spark.createDataFrame([(a,) for a, _ in amounts], "y bigint").select(text.yen_short(F.col("y"))).collect()] == [s for _, s in amounts]


def test_profiles(spark):
    files = spark.createDataFrame([("13", "p", "expenditure", 2, ["款", "項", "目", "事業名", "予算額"]), ("13", "q", "expenditure", 1, ["款", "項", "目", "施策", "金額"]), ("14", "r", "revenue", 1, ["款", "金額"])], "code string, file string, direction string, position int, header array<string>")
    g = profile.granularity(files)
    assert {r.file: r.granularity for r in g.collect()} == {"p": "project", "q": "project", "r": "category"}
    assert [(r.code, r.file) for r in profile.best_files(g).collect()] == [("13", "q")]
    standard = list(profile.BULLETIN_COLUMNS)
    aliased = [*standard[:12], "発行元所在地_建物名等_方書_", *standard[13:]]
    heads = spark.createDataFrame([("a", standard), ("b", aliased), ("c", standard[:-1]), ("d", [*standard, "分類"]), ("e", ["_id", *standard, ""]), ("f", [standard[1], standard[0], *standard[2:]])], "file string, header array<string>")
    assert {r.file: r.conformance for r in profile.conformance(heads).collect()} == {"a": "conformant", "b": "conformant", "c": "broken", "d": "variant", "e": "conformant", "f": "variant"}
    cells = ["131016", "", "千代田区", "だより", " ", "", "", "", "", "", "", "", "", "", "", "https://x.jp/a.pdf"]
    rows = profile.bulletin_rows(spark.createDataFrame([("a", standard, cells), ("b", standard, ["13", *cells[1:-1], "nowhere"])], "file string, header array<string>, cells array<string>"))
    got = {r.file: (r.code, r.number, r.problems) for r in rows.collect()}
    assert got["a"] == ("131016", None, []) and got["b"][2] == ["code", "url"]
    assert {r.file: r.conformance for r in profile.file_conformance(rows).collect()} == {"a": "conformant", "b": "broken"}
    lines = spark.createDataFrame([(2024, "expenditure", ["a"], "01", "10", "x"), (2024, "expenditure", ["a"], "02", "x", 'q"')], "year int, direction string, header array<string>, fund string, amount string, raw_line string")
    y = profile.year_compatibility(lines, ["a"]).first()
    assert (y.same_header, y.whole_amounts, y.quoted_rows, y.funds, y.total) == (True, False, 1, ["01", "02"], 10)
    data = spark.createDataFrame([("t131016", "令和予算", "csv"), ("t131016", "地図", "CSV"), ("x", "予算", "CSV"), ("t999999", "予算", "CSV")], "organization string, title string, format string")
    assert profile.candidates(data, spark.createDataFrame([("131016",)], "code string")).count() == 1
    assert [r[0] for r in profile.expand_ranges(spark.createDataFrame([("l{1..3}:c",), ("z",)], "n string"), "n").collect()] == ["l1:c", "l2:c", "l3:c", "z"]


def test_gates(spark):
    schema = "code string, name string, ocd_id string, system_family string, transcript_url string, tenant string, tenant_id int, ai_crawler string, fetch string, redistribute string, constraints array<string>, policy_version string"
    good = ("131016", "n", "ocd/city:131016", "own", "https://a.jp/x", None, None, "allowed", "allow", "deny", [], "1")
    bad = ("131024", "n", "ocd/city:1", "dnp", None, None, None, "disallowed", "allow", "allow", ["no-source", "copyright-unverified", "new"], "0")
    gates = spark.createDataFrame([good, bad], schema)
    errors = profile.gate_errors(gates, ["no-source", "copyright-unverified"], "1")
    assert errors.where("code = '131016'").count() == 0 and errors.where("code = '131024'").count() == 9
    assert profile.registry_errors(gates, spark.createDataFrame([("131016",), ("1",)], "code string")).count() == 2
    assert profile.fetch_targets(gates).count() == 1 and profile.by_origin(gates).first().origin == "https://a.jp"


def test_streaming_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, body in (("a.csv", "x"), ("b.csv", "x"), ("c.csv", "y")):
        (tmp_path / "in" / name).write_text(body)
    for _ in range(2):
        ingest.ingest_available(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    # A file with an old time isn't late, and bytes that came long ago aren't new.
    for name, body in (("d.csv", "z"), ("e.csv", "y")):
        (tmp_path / "in" / name).write_text(body)
        os.utime(tmp_path / "in" / name, (10**9, 10**9))
    ingest.ingest_available(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(bytes(r.content) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [b"x", b"y", b"z"]


def test_taxonomy(spark):
    from tallywright.sources.taxonomy import column_types

    text = "# T\n##### `value`\n\n- _dataType_: number\n\n##### `a:level{1..2}:code`\n\nText\n- _dataType_: `string`\n- _unique_: true\n\n##### `a:level{1..2}:label`\n- _dataType_: string\n- _labelOf_: `a:level1:code`\n## Next\n- _prior_: x\n##### `none`\nnothing"
    got = [tuple(r) for r in column_types(spark.createDataFrame([(text,)], "value string")).collect()]
    assert got == [("value", "number", False, None, None), ("a:level1:code", "string", True, None, None), ("a:level2:code", "string", True, None, None), ("a:level1:label", "string", False, "a:level1:code", None), ("a:level2:label", "string", False, "a:level2:code", None)]


def test_ingest_of_a_source(spark, tmp_path):
    (tmp_path / "sources.toml").write_text(REGISTRY.replace('"review"', '"allow"'))
    source = catalog.load_sources(str(tmp_path / "sources.toml"))["132047:2024"]
    packages = spark.createDataFrame([("t132047", "予算", [(r.resource_name, f"u{i}") for i, r in enumerate(source.resources)])], "organization string, title string, resources array<struct<name:string,url:string>>")
    asked = []

    def fetch(url):
        asked.append(url)
        return 200, "款,額\r\n01Ⅰ,1\r\n".encode("cp932")

    assert raw.ingest_source(spark, source, packages, fetch, str(tmp_path / "raw")) == {"expenditure": True, "revenue": True} and asked == ["u0", "u1"]
    assert raw.ingest_source(spark, source, packages, fetch, str(tmp_path / "raw")) == {"expenditure": False, "revenue": False}
    record = json.loads((tmp_path / "raw/jurisdiction=132047/year=2024/phase=approved/direction=revenue/provenance.json").read_text())
    assert record["request_url"] == "u1" and record["license_id"] == "CC-BY-4.0" and "令和６年度" in record["fiscal_year_basis"]
    from dataclasses import replace

    with pytest.raises(PermissionError):
        raw.ingest_source(spark, replace(source, redistribute="deny"), packages, fetch, str(tmp_path / "raw"))
    with pytest.raises(ValueError, match="name the year"):
        raw.ingest_source(spark, replace(source, fiscal_year_label="令和７年度"), packages, fetch, str(tmp_path / "raw"))
    with pytest.raises(ConnectionError):
        raw.ingest_source(spark, source, packages, lambda url: (404, b""), str(tmp_path / "raw"))


def test_surveys_of_folders(spark, tmp_path):
    from tallywright.__main__ import main

    years = tmp_path / "years"
    years.mkdir()
    head = "01会計,02款,03項,04目,05事項,06節,07細々節,08予算額"
    (years / "令和６年度（歳出）.csv").write_bytes(f"{head}\r\n01一般,a,b,c,d,e,f,10\r\n02特別,a,b,c,d,e,f,-3\r\n".encode("shift_jis"))
    (years / "平成30年度（歳出）.csv").write_text(f'{head}\n01一般,a,b,c,d,e,f,"1,000"\n')
    got = {(r.year, r.direction): (r.compatible, r.total, r.basis) for r in surveys.years(spark, str(years), {"expenditure": head.split(",")}, [2018, 2023, 2024]).collect()}
    assert got[2024, "expenditure"][:2] == (True, 7) and got[2018, "expenditure"][0] is False and "quoted" in got[2018, "expenditure"][2] and got[2023, "expenditure"] == (None, None, "no file")
    assert main(["survey", "--files", str(years), "--jurisdiction", "132047", "--years", "2018-2024", "--write", str(tmp_path / "dump")]) == 0
    assert spark.read.json(str(tmp_path / "dump/years")).count() == 14
    files = tmp_path / "files"
    for code, name, body in (("132047", "歳出.csv", "01款,02目,05事項,08予算額\n1,2,3,4\n"), ("132047", "歳出2.csv", "款,予算額\n"), ("131016", "page.csv", " <!DOCTYPE html>")):
        (files / code).mkdir(parents=True, exist_ok=True)
        (files / code / name).write_text(body)
    found = {r.file.split("/")[1]: (r.kind, r.granularity, r.rows) for r in surveys.granularity(spark, str(files)).collect()}
    assert found["歳出.csv"] == ("text", "project", 1) and found["歳出2.csv"][1] == "category" and found["page.csv"][:2] == ("html", "unchecked")
    bulletins = tmp_path / "bulletins"
    bulletins.mkdir()
    standard = ",".join(profile.BULLETIN_COLUMNS)
    row = ",".join(["131016", "", "千代田区", "だより", *[""] * 11, "https://x.jp"])
    (bulletins / "a.csv").write_text(f"{standard}\n{row}\n")
    (bulletins / "b.csv").write_text(f"{standard}\n" + row.replace("131016", "13") * 1 + "\n" + f"{row}\n")
    (bulletins / "c.csv").write_text("<html>")
    verdicts = {r.file: (r.conformance, r.row_failures, r.note) for r in surveys.bulletins(spark, str(bulletins)).collect()}
    assert verdicts["a.csv"] == ("conformant", None, None) and verdicts["b.csv"] == ("broken", ["2: code"], "rows at fault") and verdicts["c.csv"][::2] == ("broken", "HTML, not CSV")
    gate = {"fetch": "allow", "redistribute": "deny", "constraints": [], "policyVersion": "1", "evaluatedAt": "2024-01-01"}
    body = {"transcript": {"systemFamily": "own-site", "transcriptUrl": "https://a.jp/x", "robots": {"verdict": "none", "aiCrawler": "unchecked"}, "gate": gate, "confidence": "confirmed"}, "status": {"driver": "not-started", "ingestValidated": False, "published": False}}
    document = {"policy": {"version": "1", "constraints": {}}, "jurisdictions": {"131016": body}}
    registry = {"jurisdictions": {"131016": {"name": "n", "ocdId": "ocd-division/country:jp/prefecture:13/city:131016", "tokyoCatalogDatasets": None}}}
    for wrong in (False, True):
        if wrong:
            gate["fetch"] = "maybe"
        (tmp_path / "gates.json").write_text(json.dumps(document))
        (tmp_path / "registry.json").write_text(json.dumps(registry))
        assert main(["gates", "--gates", str(tmp_path / "gates.json"), "--registry", str(tmp_path / "registry.json")]) == int(wrong)


def test_robots_answers(spark):
    rows = [("a", 200, "text/plain", b"User-agent: *"), ("b", 200, "text/html; x", b"x"), ("c", 200, None, b"  <HTML>"), ("d", 404, "text/plain", b"x"), ("e", None, None, None)]
    got = {r.origin: r.rules for r in profile.robots(spark.createDataFrame(rows, "origin string, status int, content_type string, content binary")).collect()}
    assert got == {"a": "User-agent: *", "b": None, "c": None, "d": None, "e": None}


@pytest.fixture
def server():
    """Answers on this machine: a catalogue of two pages, files, and things that go wrong."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer
    from urllib.parse import parse_qs, urlsplit

    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            url, base = urlsplit(self.path), f"http://127.0.0.1:{self.server.server_port}"
            if url.path == "/search":
                start = int(parse_qs(url.query)["start"][0])
                entry = [{"name": "a", "title": "予算", "organization": {"name": "t132047"}, "resources": [{"name": n, "url": f"{base}/{i}.csv", "format": "CSV"} for i, n in enumerate(("令和６年度（歳出）", "令和６年度（歳入）"))]}]
                body = json.dumps({"result": {"count": 2, "results": [{"name": "old", "title": "x", "organization": None}] if start == 0 else entry}}).encode()
            elif url.path.endswith(".csv"):
                body = "款,額\r\n01Ⅰ,1\r\n".encode("cp932")
            elif url.path == "/robots.txt":
                body = b"User-agent: *"
            elif url.path == "/large":
                body = b"x" * 1000
            else:
                self.send_error(404)
                return
            self.send_response(200)
            self.send_header("Content-Length", str(len(body) + (url.path == "/cut")))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    running = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=running.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{running.server_port}", asked
    running.shutdown()


def test_http(spark, tmp_path, server, capsys):
    from tallywright.__main__ import main
    from tallywright.sources import http

    base, asked = server
    good = http.get(f"{base}/large")
    assert good.status == 200 and good.body == b"x" * 1000 and len(good.sha256) == 64
    assert http.get(f"{base}/large", most=999).body is None and "999" in http.get(f"{base}/large", most=999).reason
    assert http.get(f"{base}/none").status == 404 and http.get("http://127.0.0.1:1/x").status is None
    with pytest.raises(ConnectionError):
        http.body_of(f"{base}/none")
    (tmp_path / "sources.toml").write_text(REGISTRY.replace('"review"', '"allow"').replace("https://c/search", f"{base}/search"))
    args = ["ingest", "--sources", str(tmp_path / "sources.toml"), "--key", "132047:2024", "--raw", str(tmp_path / "raw")]
    assert main(args) == 0 and main(args) == 0
    said = capsys.readouterr().out
    assert said.count("written") == 2 and said.count("there already") == 2 and sum("start=1" in x for x in asked) == 2
    gate = {"systemFamily": "own-site", "transcriptUrl": f"{base}/x", "robots": {"verdict": "none", "aiCrawler": "unchecked"}, "gate": {"fetch": "allow", "redistribute": "deny", "constraints": [], "policyVersion": "1"}}
    (tmp_path / "gates.json").write_text(json.dumps({"jurisdictions": {"131016": {"transcript": gate}, "131024": {"transcript": gate}}}))
    (tmp_path / "registry.json").write_text(json.dumps({"jurisdictions": {}}))
    asked.clear()
    r = surveys.robots(spark, str(tmp_path / "gates.json"), str(tmp_path / "registry.json"), http.get).collect()
    assert len(r) == 1 and r[0].codes == ["131016", "131024"] and r[0].found and r[0].rules == "User-agent: *" and asked == ["/robots.txt"]


def test_graph_of_a_build(spark, tmp_path):
    from tallywright.__main__ import main
    from tallywright.plans.budget_queries import MANIFEST, RESULTS

    (tmp_path / "manifest.json").write_text(json.dumps(MANIFEST))
    (tmp_path / "results.json").write_text(json.dumps({"results": [{"unique_id": i, "status": s, "failures": n, "message": m} for i, s, n, m in RESULTS]}))
    paths = (str(tmp_path / "manifest.json"), str(tmp_path / "results.json"))
    got = surveys.graph(spark, *paths)
    assert [(r.label, r.contains_judgment) for r in got["nodes"].collect()] == [("raw", False), ("stg", False), ("core", True), ("public", False), ("rules", True), ("canon", False), ("derived", True)]
    assert got["edges"].count() == 5 and tuple(got["summary"].first()) == (1, 2, 1)
    assert main(["graph", "--manifest", paths[0], "--results", paths[1], "--write", str(tmp_path / "out")]) == 1
    assert spark.read.json(str(tmp_path / "out/checks")).count() == 4
    (tmp_path / "bulletins.json").write_text(json.dumps({"note": "", "datasets": {"131016": {"title": "t", "formats": ["CSV"], "url": None, "count": 1}, "x": {"title": None, "formats": [], "url": "no", "count": 0, "schemaCheck": {"conformance": "other"}}}}))
    assert sorted(r.path for r in surveys.bulletin_registry(spark, str(tmp_path / "bulletins.json")).collect()) == ["code", "count", "schemaCheck", "title", "url"]
