import json

import pytest

from tallyforge import adapters, cli, config
from tallyforge.operators import extraction
from tallyforge.sources import repair
from tallyforge.plans import domain
from tallyforge.plans.domain import table

SF = "/root/testdata/sf0.001"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "metrics.yaml").write_text("profiles:\n  bank:\n    reporting_priority: [IFRS]\n    metrics:\n      revenue: {synonyms: [a], unit: RUB, only_in_sources: [IFRS]}\n      net: {unit: RUB, aggregation_hint: sum}\n")
    (tmp_path / "tickers.yaml").write_text("tickers:\n  - {ticker: A, name: x, e_disclosure_id: 7, profile: bank}\n  - {ticker: B, name: y, e_disclosure_id: REPLACE_ME, profile: bank}\n")
    (tmp_path / "event_types.yaml").write_text("event_types:\n  - {code: other, display_name: o}\n")
    (tmp_path / "app.yaml").write_text("http: {api_key: abc, rate: 1}\n")
    return tmp_path


def test_config(spark, folder):
    s = config.load(str(folder))
    assert config.overlap_ids(s) == {"7"}
    assert config.spec_table(spark, s).count() == 2 and config.ticker_table(spark, s).count() == 2
    assert list(config.answer_schema(s, "bank", "RSBU")["properties"]["extractions"]["items"]["properties"]["metrics"]["properties"]) == ["net"]
    assert "Note: sum" in config.system_prompt(s, "bank", "RSBU") and "Note" not in config.system_prompt(s, "bank", "IFRS")
    assert '"***"' in config.dump(s) and "abc" not in config.dump(s)
    (folder / "tickers.yaml").write_text("tickers:\n  - {ticker: A, wrong: 1}\n")
    with pytest.raises(config.ConfigError, match=r"tickers\[0\]: unknown field 'wrong'"):
        config.load(str(folder))


def test_durations():
    assert config.duration("2d").days == 2 and config.duration(" 1w ").days == 7 and config.duration("90s").seconds == 90
    with pytest.raises(config.ConfigError):
        config.duration("soon")


class Client:
    def __init__(self, *answers):
        self.answers = list(answers)

    def get(self, url):
        return self.answers.pop(0)


def test_pacing_and_robots():
    slept = []
    c = adapters.PolitePacing(Client((503, {"retry-after": "999"}, b""), (429, {}, b""), (200, {}, b"x")), sleep=slept.append, clock=lambda: 0.0)
    assert c.get("u")[0] == 200 and slept == [60.0, 1.0, 2.0, 1.0]
    assert adapters.robots_rule(200, "User-agent: *\nDisallow: /a").can_fetch("x", "http://e/b")
    assert not adapters.robots_rule(200, "User-agent: *\nDisallow: /a").can_fetch("x", "http://e/a")
    assert adapters.robots_rule(404).can_fetch("x", "http://e/a") and adapters.robots_rule(None).can_fetch("x", "http://e/a")
    assert not adapters.robots_rule(503).can_fetch("x", "http://e/a")


def test_replication_guards(tmp_path):
    class Cloud:
        def upsert_file(self, path, folder, name, archive):
            return f"{folder}/{name}"

    f = tmp_path / "f"
    f.write_text("x")
    assert adapters.replicate(Cloud(), False, "d", str(f), "n")[1] == "disabled or no provider"
    assert adapters.replicate(Cloud(), True, "", str(f), "n")[1] == "no folder"
    assert adapters.replicate(Cloud(), True, "d", str(f) + "x", "n")[1] == "no local file"
    assert adapters.replicate(Cloud(), True, "d", str(f), "n") == ("d/n", None)


def test_rtf():
    body = b"{\\rtf1{\\fonttbl{\\f0 Arial;}}\\'cf\\'f0\\'e8 \\u1074?\\par next}"
    assert adapters.rtf_pages(body) == [(1, "При в\nnext")]


def test_cli_runs_exports_and_reports(spark, tmp_path, folder, capsys):
    d = str(tmp_path / "state")
    p = table(spark, SF, "publications")
    p.where("false").write.parquet(f"{d}/publications.parquet")
    p.limit(400).selectExpr("* EXCEPT (status, last_error)", "'discovered' AS status", "CAST(NULL AS STRING) AS last_error").write.parquet(f"{d}/found.parquet")
    table(spark, SF, "filings").write.parquet(f"{d}/documents.parquet")
    table(spark, SF, "metrics").where("false").write.parquet(f"{d}/metrics.parquet")
    spark.createDataFrame([], "publication_id string, ticker string, code string, message string").write.parquet(f"{d}/qa_issues.parquet")
    for name in ("ticks", "skiplist", "companies", "tickers"):
        table(spark, SF, name).write.parquet(f"{d}/{name}.parquet")
    for argv in (["run"], ["update"], ["validate"], ["export", str(tmp_path / "out")], ["export", str(tmp_path / "book"), "--format", "xlsx"], ["evolve", "tick"], ["evolve", "status"], ["evolve", "report"], ["evolve", "reset", "--company", "9"], ["evolve", "canary"], ["evolve", "cleanup"], ["prune", "--older-than", "0s"]):
        assert cli.main(["--state", d, *argv], spark) == 0, argv
    assert spark.read.parquet(str(tmp_path / "out/metrics")).count() > 0
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"metrics", "tickers", "meta", "qa_issues"} and (tmp_path / "book/mart.xlsx").exists()
    assert cli.main(["--state", d, "status"], spark) == 3
    assert cli.main(["config", str(folder)]) == 0 and cli.main(["config", d]) == 2
    assert cli.main(["--state", SF, "query", "a9_status_counts", "--out", str(tmp_path / "q")], spark) == 0


def test_views_are_ordered():
    sql = domain.oracle("metrics", "SELECT 1")
    assert sql.index("d_period_sums AS") < sql.index("d_metrics AS")


class Scripted:
    """Answers by address; an exception is raised."""

    def __init__(self, answers):
        self.answers, self.asked = answers, []

    def get(self, url):
        self.asked.append(url)
        answer = self.answers[url]
        answer = answer.pop(0) if isinstance(answer, list) else answer
        if isinstance(answer, Exception):
            raise answer
        return answer


def test_transport_errors_are_tried_again_and_downloads_are_whole(tmp_path):
    slept = []
    client = Scripted({"u": [adapters.TransportError("reset"), (503, {"Retry-After": "Thu, 01 Jan 1970 00:00:20 GMT"}, b""), (200, {}, b"abc")], "v": adapters.TransportError("down"), "w": (404, {}, b"no")})
    pacing = adapters.PolitePacing(client, rate=1e9, sleep=slept.append, clock=lambda: 0.0, now=lambda: 5.0)
    assert pacing.download("u", tmp_path / "d" / "f.pdf") == 3 and (tmp_path / "d" / "f.pdf").read_bytes() == b"abc"
    assert [s for s in slept if s > 0.1] == [1.0, 15.0]
    with pytest.raises(adapters.TransportError):
        pacing.get("v")
    assert client.asked.count("v") == 4
    with pytest.raises(adapters.TransportError, match="404"):
        pacing.download("w", tmp_path / "g.pdf")
    assert [p.name for p in (tmp_path / "d").iterdir()] == ["f.pdf"] and not (tmp_path / "g.pdf").exists()


def test_robots_are_asked_once_for_a_host():
    now = [0.0]
    client = Scripted({"http://a/robots.txt": (200, {}, b"User-agent: *\nDisallow: /x"), "http://b/robots.txt": adapters.TransportError("down"), "http://c/robots.txt": (500, {}, b""), "http://a/y": (200, {}, b"ok")})
    robots = adapters.RobotsCache(client, clock=lambda: now[0])
    assert robots.is_allowed("http://a/y") and not robots.is_allowed("http://a/x/1") and robots.is_allowed("http://b/x") and not robots.is_allowed("http://c/")
    assert client.asked.count("http://a/robots.txt") == 1
    now[0] = 4000.0
    robots.is_allowed("http://a/y")
    assert client.asked.count("http://a/robots.txt") == 2
    pacing = adapters.PolitePacing(client, robots=robots, sleep=lambda s: None)
    assert pacing.get("http://a/y")[2] == b"ok"
    with pytest.raises(adapters.Forbidden):
        pacing.get("http://a/x")


def test_pages_are_read_again_and_failures_are_rows():
    class Engine:
        def recognize(self, content, page, languages, resolution):
            if page == 3:
                raise ValueError("no image")
            if page == 4 and resolution == 200:
                raise ValueError("once")
            return "x" * (1000 if page == 1 else resolution if page == 2 else 5)

    got = adapters.recognized_pages(Engine(), b"", [1, 2, 3, 4])
    assert [(p, t and len(t), e) for p, t, e in got] == [(1, 1000, None), (2, 300, None), (3, None, "ValueError: no image"), (4, 5, None)]


def test_upsert_keeps_one_file_of_a_name():
    class Drive(dict):
        def find(self, folder, name):
            return (folder, name) if (folder, name) in self else None

        def create(self, folder, name, path):
            assert (folder, name) not in self
            self[folder, name] = [path]
            return f"link of {name}"

        def update(self, file_id, path):
            self[file_id].append(path)
            return f"link of {file_id[1]}"

    drive = Drive()
    storage = adapters.UpsertingStorage(drive, lambda: "2024-05-06")
    assert storage.upsert_file("p1", "f", "a.xlsx", True) == storage.upsert_file("p2", "f", "a.xlsx", False) == "link of a.xlsx"
    assert drive == {("f", "a.xlsx"): ["p1", "p2"], ("f", "a_2024-05-06.xlsx"): ["p1"]}


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ('{"a": 1}', {"a": 1}),
        ("Here it is:\n```json\n{'a': [1, 2,], b: None,}\n```", {"a": [1, 2], "b": None}),
        ('{"a": {"b": "c", "d": [1, {"e": tru', {"a": {"b": "c", "d": [1, {"e": "tru"}]}}),
        ('{"a": "line\nfeed" "b": 2 // note\n}', {"a": "line\nfeed", "b": 2}),
        ('{"q": "say \\"x\\" \\u0041", "n": -1.5e3}', {"q": 'say "x" A', "n": -1500.0}),
        ('{"a": }', {"a": None}),
        ("[1, 2]", None),
        ("no object", None),
        (None, None),
        ("{", None),
        ("{" * 5000, None),
    ],
)
def test_answers_are_repaired(text, value):
    got = repair.repaired(text)
    assert (json.loads(got) if got is not None else None) == value


def test_broken_answers_keep_their_rows(spark):
    good = extraction.FixedProvider().complete("a prompt of some kind")
    rows = [("A", "1", "FY", good), ("B", "2", "FY", "Sure!\n" + good.replace('"', "'").replace("null", "None")[:-2]), ("C", "3", "FY", "sorry")]
    got = extraction.extracted_metrics(spark.createDataFrame(rows, "ticker string, publication_id string, expected_type string, answer string"))
    by = {t: sorted((r.metric_name, r.value) for r in got.collect() if r.ticker == t) for t in "ABC"}
    assert by["A"] == by["B"] and by["A"] and not by["C"]
