"""Semantics that are easy to get wrong, on inline rows."""

import datetime
import difflib
import io
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyforge.functions import classify, markup, period, text
from tallyforge.operators import control, documents, extraction, mart, quality_rules, state
from tallyforge.plans import registry
from tallyforge.sources import files, listings, logs

METRICS = "ticker string, reporting_date string, period_type string, reporting_standard string, metric_name string, value double, currency string, unit string"


def metrics(spark, *rows):
    return spark.createDataFrame([("T", d, p, "IFRS", n, v, c, u) for d, p, n, v, c, u in rows], METRICS)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_previous_period_is_chosen_by_period_not_by_metric(spark):
    m = metrics(spark, ("2023", "FY", "revenue", 100.0, "R", "o"), ("2024", "FY", "net_income", 5.0, "R", "o"), ("2025", "FY", "revenue", 5000.0, "R", "o"))
    assert quality_rules.suspicious_change(m).count() == 0


@pytest.mark.parametrize(("now", "before", "found"), [(1100.0, 100.0, 1), (1000.0, 100.0, 0), (500.0, 100.0, 0), (0.0, 100.0, 0), (None, 100.0, 0), (-1100.0, 100.0, 1)])
def test_change(spark, now, before, found):
    m = metrics(spark, ("2023", "FY", "revenue", before, "R", "o"), ("2024", "FY", "revenue", now, "R", "o"), ("2023", "H1", "revenue", 1.0, "R", "o"))
    assert quality_rules.suspicious_change(m).count() == found


@pytest.mark.parametrize(("values", "found"), [((1000.0, 600.0, 400.0), 0), ((1000.0, 600.0, 350.0), 1), ((1000.0, 600.0, None), 0), ((1000.0, 600.0, 395.0), 0)])
def test_balance(spark, values, found):
    names = ("total_assets", "total_equity", "total_liabilities")
    m = metrics(spark, *(("2024", "FY", n, v, "R", "o") for n, v in zip(names, values, strict=True)))
    assert quality_rules.balance_mismatch(m).count() == found


def test_signs_and_mixed(spark):
    m = metrics(spark, ("2024", "FY", "revenue", -1.0, "RUB", "o"), ("2024", "FY", "net_income", -1.0, "USD", ""), ("2024", "FY", "total_assets", -1.0, None, "o"))
    assert sorted(r.code for r in quality_rules.negative_signs(m).collect()) == ["negative_assets", "negative_revenue"]
    assert quality_rules.mixed(m, "currency", "currency_mixed", ("ticker",)).first()["values"] == ["RUB", "USD"]
    assert quality_rules.mixed(m, "unit", "unit_mixed", ("ticker",)).count() == 0


def test_last_value_wins_and_null_never_replaces(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 2, 5.0), ("a", 3, None), ("b", 1, 1.0), ("b", 2, 2.0), ("c", 1, None), ("c", 2, None)], "k string, seq int, value double")
    got = {r.k: (r.seq, r.value) for r in quality_rules.dedup_rows(rows, ("k",)).collect()}
    assert got == {"a": (2, 5.0), "b": (2, 2.0), "c": (1, None)}


def test_empty_source_list_differs_for_extraction_and_validation(spark):
    specs = spark.createDataFrame([("m", []), ("n", None)], "metric_name string, only_in_sources array<string>").withColumn("reporting_standard", F.lit("IFRS"))
    got = specs.select("metric_name", quality_rules.applicable(specs, False).alias("e"), quality_rules.applicable(specs, True).alias("v"))
    assert {tuple(r) for r in got.collect()} == {("m", True, False), ("n", True, True)}


@pytest.mark.parametrize(("have", "wanted", "found"), [(2, 5, True), (3, 5, False)])
def test_completeness(spark, have, wanted, found):
    m = metrics(spark, *(("2024", "FY", f"m{k}", 1.0 if k < have else None, "R", "o") for k in range(wanted))).withColumn("profile", F.lit("bank"))
    specs = spark.createDataFrame([("bank", f"m{k}", None) for k in range(wanted)], "profile string, metric_name string, only_in_sources array<string>")
    r = quality_rules.completeness(m, specs, ("ticker",)).first()
    assert (r.requested, r.extracted, r.is_incomplete) == (wanted, have, found)


def test_warnings_attach_by_name_across_periods(spark):
    m = metrics(spark, ("2023", "FY", "revenue", 1.0, "R", "o"), ("2024", "FY", "revenue", 1.0, "R", "o"), ("2024", "FY", "ebitda", 1.0, "R", "o"))
    w = spark.createDataFrame([("T", "x", ["revenue"]), ("T", "all", [])], "ticker string, code string, affected array<string>")
    got = sorted((r.reporting_date, r.metric_name, r.qa_codes) for r in quality_rules.attach(m, w, ("ticker",)).collect())
    assert got == [("2023", "revenue", ["all", "x"]), ("2024", "ebitda", ["all"]), ("2024", "revenue", ["all", "x"])]


@pytest.mark.parametrize(
    ("label", "want"),
    [
        ("2025", (2025, "FY")), ("2026, 3 месяца", (2026, "Q1")), ("2025, 6 месяцев", (2025, "H1")), ("2025, 9 месяцев", (2025, "9M")), ("I квартал 2025", (2025, "Q1")),
        ("II квартал 2024", (2024, "Q2")), ("I полугодие 2024", (2024, "H1")), ("второе полугодие, 2024", (2024, "H2")), ("За  2025 год", (2025, "FY")), ("за 3 КВАРТАЛ 2024 г.", (2024, "Q3")),
        ("Бухгалтерская отчётность за 2025", (2025, "FY")), ("Информация о компании 2025", None), ("", None), ("junk", None), (None, None), ("2021, IV квартал", (2021, "Q4")),
    ],
)
def test_periods(spark, label, want):
    got = one(spark, period.reporting_period(F.lit(label).cast("string")))
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize(("value", "want"), [("1.4.2026", "2026-04-01"), ("2026-04-01", "2026-04-01"), (" 01/04/2026 ", "2026-04-01"), ("1-4-2026", "2026-04-01"), ("1.4.26", None), ("31.02.2026", None), ("", None), (None, None)])
def test_dates(spark, value, want):
    got = one(spark, text.parsed_date(F.lit(value).cast("string")))
    assert got == (datetime.date.fromisoformat(want) if want else None)


def test_markers(spark):
    def standard(t):
        return one(spark, classify.reporting_standard(F.lit(t)))

    assert standard("Отчётность по МСФО, группа компаний; РСБУ") == "IFRS"
    assert standard("МСФО и РСБУ") == "OTHER" and standard("") == "OTHER" and standard("ничего") == "OTHER"
    assert standard("Отчет эмитента эмиссионных бумаг") == "ISSUER"
    assert one(spark, classify.report_form(F.lit("Balance sheet. Cash flow statement"))) == "balance_sheet"
    assert one(spark, classify.report_form(F.lit("x"))) == "other"
    assert one(spark, text.occurrences(F.lit("aaaa"), "aa")) == 2


def test_anchor(spark):
    t = "Заключение аудитора\r\n  Бухгалтерский   баланс \nАктив 1\nОтчёт о финансовых результатах\n"
    c = spark.range(1).select(classify.from_anchor(F.lit(t)).alias("c")).first().c
    assert c.content.startswith(classify.LEAD) and c.content.removeprefix(classify.LEAD).strip().startswith("Бухгалтерский") and not c.capped
    c = spark.range(1).select(classify.from_anchor(F.lit("x Форма по ОКУД 0710001 y"), max_chars=5).alias("c")).first().c
    assert (c.anchor_at, c.capped, c.content.removeprefix(classify.LEAD)) == (3, True, "Форма")
    assert spark.range(1).select(classify.from_anchor(F.lit("в бухгалтерский баланс входит")).alias("c")).first().c.content is None


def test_section():
    head = "1.4. Основные финансовые показатели"
    body = head + "\n" + "строка\n" * 200
    assert classify.cut_section("", 10)[3] == ["empty_text"]
    assert classify.cut_section("нет", 10)[3] == ["section_not_found"]
    assert classify.cut_section(head + "\n" + head, 10)[3] == ["section_1_4_only_in_toc"]
    content, label, end, warnings = classify.cut_section(body + "1.5. Далее\n2. Ещё", 100_000)
    assert content == body and label == "Основные финансовые показатели" and end == "1.5" and warnings == []
    content, _, _, warnings = classify.cut_section(head + "\n" + "x" * 4000 + "\n" + body, 600)
    assert len(content) == 600 and warnings == ["section_repeated", "section_end_not_found", "section_truncated"]
    assert classify.cut_section(head + " короткий", 600)[3][-1] == "section_1_4_too_short"
    with pytest.raises(ValueError, match="positive"):
        classify.cut_section("x", 0)


def test_cleaning(spark):
    def clean(t):
        return spark.createDataFrame([(t,)], "t string").select(text.cleaned(text.compatible(F.col("t")))).first()[0]

    assert clean("фи­нансы") == "финансы"
    assert clean("финан-\nсовая") == "финансовая"
    assert clean(" a  b \n\n\n\nc \r\nd\t") == "a b\n\nc\nd"
    assert clean(None) == ""


def test_recurring_lines(spark):
    def run(*pages):
        df = spark.createDataFrame([(1, k + 1, p) for k, p in enumerate(pages)], "doc_id int, page_number int, page string")
        return [r.page for r in documents.without_recurring(df).orderBy("page_number").collect()]

    assert run("H\na", "H\nb", "H\nc") == ["a", "b", "c"]
    assert run("H\na", "H\nb") == ["H\na", "H\nb"]
    assert run("H\na", "H\nb", "c", "d", "e", "H") == ["H\na", "H\nb", "c", "d", "e", "H"], "three of six is not more than half"


@pytest.mark.parametrize(("budget", "want"), [(6, [("aaaa", True), ("bb", True)]), (8, [("aaaa", True), ("bbbb", True)]), (99, [("aaaa", False), ("bbbb", False), ("cc", False)])])
def test_budget(spark, budget, want):
    df = spark.createDataFrame([(1, 1, "aaaa"), (1, 2, "bbbb"), (1, 3, "cc")], "doc_id int, page_number int, page string")
    assert [(r.page, r.truncated) for r in documents.within_budget(df, budget).orderBy("page_number").collect()] == want


def test_unknown_status_and_unit_raise(spark):
    p = spark.createDataFrame([("a", "written", None, "h")], "publication_id string, status string, last_error string, file_hash string")
    with pytest.raises(PySparkException, match="unknown status"):
        state.mark_status(p, p.withColumn("status", F.lit("lost"))).collect()
    with pytest.raises(PySparkException, match="unknown unit"):
        spark.range(1).select(text.in_unit(F.lit(1.0), F.lit("dozens"), F.lit("ones"))).collect()
    assert one(spark, text.in_unit(F.lit(None).cast("double"), F.lit("dozens"), F.lit("ones"))) is None
    assert one(spark, text.in_unit(F.lit(2.5), F.lit("millions"), F.lit("thousands"))) == 2500


def test_status_update_clears_the_error_but_keeps_the_hash(spark):
    p = spark.createDataFrame([("a", "failed", "e", "h"), ("b", "failed", "e", "h")], "publication_id string, status string, last_error string, file_hash string")
    d = spark.createDataFrame([("a", "written", None, None)], p.schema)
    assert sorted(map(tuple, state.mark_status(p, d).collect())) == [("a", "written", None, "h"), ("b", "failed", "e", "h")]


def test_402_in_any_case(spark):
    p = spark.createDataFrame([("a", "failed", "http 402"), ("b", "failed", None), ("c", "written", "HTTP 402")], "publication_id string, status string, last_error string")
    assert [tuple(r) for r in state.reset_unavailable(p).orderBy("publication_id").collect()] == [("a", "extracted", None), ("b", "failed", None), ("c", "written", "HTTP 402")]


def test_give_up_at_ten(spark):
    s = spark.createDataFrame([("1", "give_up", 9, None), ("2", "manual_blacklist", 3, None)], "company_id string, reason string, failure_count int, last_tick_id long")
    f = spark.createDataFrame([("1", 7), ("1", 8), ("2", 7), ("3", 7)], "company_id string, tick_id long")
    assert sorted(map(tuple, state.bump_failures(s, f).collect())) == [("1", "give_up", 10, 8), ("2", "manual_blacklist", 4, 7), ("3", "give_up", 1, 7)]


def test_ids_sort_as_text_and_unfinished_ticks_count(spark):
    c = spark.createDataFrame([("17", "a", "bank"), ("1210", "b", "bank"), ("3", "c", "bank"), ("4", "d", "bank")], "company_id string, name string, type string")
    s = spark.createDataFrame([("9", "give_up", 1, None)], "company_id string, reason string, failure_count int, last_tick_id long")
    t = spark.createDataFrame(
        [(1, "fail", "2024-01-01T00:00:00+00:00", '[{"company_id":"17"}]'), (2, None, None, '[{"company_id":"17"}]'), (3, "ok", "2024-01-09T00:00:00+00:00", '[{"company_id":"3"}]'), (4, "fail", "x", '[{"company_id":"4"}]'), (5, "ok", "x", "broken")],
        "tick_id long, verdict string, finished_at string, batch_json string",
    )
    overlap = spark.createDataFrame([("9",), ("4",)], "company_id string")
    batch, listed = control.next_batch(c, s, t, overlap, "2024-01-10 00:00:00", 5)
    assert [(r.company_id, r.priority) for r in batch.collect()] == [("1210", 0), ("17", 0)]
    assert sorted((r.company_id, r.reason) for r in listed.collect()) == [("4", "moex_overlap"), ("9", "give_up")]


SNAP = "ticker string, publications_total int, written int, skipped int, metrics_rows int, qa_issues_count int"


@pytest.mark.parametrize(
    ("before", "after", "rc", "code", "notes"),
    [
        ((5, 0, 0, 0, 0), (5, 2, 0, 5, 0), 0, "ok", "metrics +5; publications.written +2"),
        ((5, 0, 0, 3, 0), (5, 0, 0, 3, 0), 0, "ok", ""),
        ((5, 0, 0, 0, 0), (5, 0, 0, 0, 0), 0, "neutral", ""),
        ((5, 0, 0, 0, 0), (5, 0, 0, 0, 0), 1, "fail", "returncode=1"),
        ((5, 0, 0, 3, 0), (5, 0, 0, 2, 1), 0, "regression", "metrics -1; qa_issues +1"),
        ((0, 0, 0, 0, 0), (0, 0, 0, 0, 0), 0, "ok", ""),
        ((2, 0, 0, 0, 0), (2, 1, 1, 0, 0), 0, "ok", "publications.written +1"),
        ((0, 0, 0, 0, 0), (2, 1, 1, 0, 0), 0, "neutral", "publications.written +1"),
    ],
)
def test_verdicts(spark, before, after, rc, code, notes):
    b = spark.createDataFrame([("T", *before)], SNAP)
    a = spark.createDataFrame([("T", *after, rc)], SNAP + ", returncode int")
    r = control.verdicts(b, a).first()
    assert (r.code, r.notes) == (code, notes)


def test_worst_of_nothing_is_fail(spark):
    none = spark.createDataFrame([], "ticker string, code string")
    assert control.worst(none).first().code == "fail"
    some = spark.createDataFrame([("a", "ok"), ("b", "neutral")], none.schema)
    assert control.worst(some).first().code == "neutral"


def test_line_owner_with_dashes(spark):
    lines = spark.createDataFrame([(1, "A-B-3-x-1"), (2, "A-3-1"), (3, None), (4, "known"), (5, "nodash")], "seq long, publication_id string")
    pubs = spark.createDataFrame([("known", "Z")], "publication_id string, ticker string")
    tickers = spark.createDataFrame([("A",), ("A-B",)], "ticker string")
    got = {r.seq: r.owner for r in control.owner_of(lines, pubs, tickers).collect()}
    assert got == {1: "A-B", 2: "A", 3: None, 4: "Z", 5: None}


def test_listing(spark):
    row = '<tr><td>1</td><td>{label}</td><td>{period}</td><td>d</td><td>{date}</td><td class="file-cell"><a class="file-link" href="{href}" data-fileid="{id}" title="{title}">f</a></td><td></td></tr>'
    page = '<table class="files-table"><thead><tr><th>x</th></tr></thead><tbody>' + "".join(
        [
            row.format(label="R", period="2025", date="1.4.2026", href="/a", id="1", title=""),
            row.format(label="R", period="", date="01.04.2026", href="/b", id="2", title="Бухгалтерская отчетность за 2024 год"),
            row.format(label="R", period="junk", date="01.04.2026", href="/c", id="3", title=""),
            row.format(label="R", period="2025", date="soon", href="/d", id="4", title=""),
            row.format(label="R", period="2025", date="01.04.2026", href="", id="5", title=""),
            "<tr><td>few</td></tr>",
        ]
    )
    df = spark.createDataFrame([("T", 3, page + "</tbody></table>"), ("T", 4, ""), ("T", 5, "<p>nothing here"), ("T", 2, None)], "ticker string, type_code int, html string")
    got = sorted((r.publication_id, str(r.publication_date), r.reporting_period_year, r.reporting_period_type) for r in listings.publications(df).collect())
    assert got == [("T-3-1", "2026-04-01", 2025, "FY"), ("T-3-2", "2026-04-01", 2024, "FY"), ("T-3-3", "2026-04-01", None, None)]
    assert sorted(r.warning for r in listings.warnings(df).collect()) == sorted(["empty html", "empty html", "row with only 1 cells", "row with empty href/data-fileid: R", "unparseable publication_date for fileid=4", "unrecognised reporting period for fileid=3"])


def test_messages_and_links():
    page = "<body><nav>n</nav><header>h</header><main><p>a</p> <p>b <i>c</i></p><aside>x</aside></main><footer>f</footer></body>"
    assert markup.message_text(page) == "a\nb\nc" and markup.message_text("  ") == "" and markup.message_text("<body><div>only</div></body>") == "only"
    links = markup.document_links('<a href="/a.PDF">1</a><a href="/a.PDF">2</a><a href="#x.pdf">3</a><a href="mailto:a.pdf">4</a><a href="b.html">5</a><a href="c.zip?d=1">6</a>', "https://e.example/d/")
    assert links == ["https://e.example/a.PDF", "https://e.example/d/c.zip?d=1"]
    assert markup.search_results("&lt;a href='company.aspx?id=7'&gt;Name&lt;/a&gt;") == [("7", "Name", "company.aspx?id=7")]


def test_archives(spark, tmp_path):
    def packed(**members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data in members.items():
                z.writestr(name.replace("__", "/"), data)
        return bytearray(out.getvalue())

    rows = [("good", packed(a__x="1", b="22")), ("bad", packed(**{"..__x": "1"})), ("large", packed(a="x" * 100)), ("broken", bytearray(b"PK\x03\x04junk"))]
    got = files.unpack(spark.createDataFrame(rows, "path string, content binary"), max_bytes=50).collect()
    assert sorted((r.path, r.member, r.size) for r in got if r.error is None) == [("good", "a/x", 1), ("good", "b", 2)]
    assert {r.path for r in got if r.error} == {"bad", "large", "broken"}
    (tmp_path / "d").mkdir()
    for name, data in (("a.pdf", b"%PDF"), ("d/b.txt", b"b"), ("c.partial", b"c"), ("z.bin", b"PK\x03\x04"), ("y.ZIP", b"x")):
        (tmp_path / name).write_bytes(data)
    assert sorted((r.name, r.mime_type) for r in files.inventory(spark, str(tmp_path)).collect()) == [("a.pdf", "application/pdf"), ("b.txt", "text/plain")]


def test_companies(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,name,type\n1, Bank ,BANK\n2,\"Plant, big\",non_bank\n\n", encoding="utf-8")
    got = sorted(map(tuple, listings.companies(spark, str(tmp_path / "c.csv")).collect()))
    assert got == [("1", "Bank", "bank", "EDX1"), ("2", "Plant, big", "non_bank", "EDX2")]
    (tmp_path / "bad.csv").write_text("id,name,type\n1,x,shop\n", encoding="utf-8")
    with pytest.raises(PySparkException, match="bad company row"):
        listings.companies(spark, str(tmp_path / "bad.csv")).collect()


def test_log_lines_and_objects(spark):
    lines = spark.createDataFrame([(1, ' {"event":"a","status":5} '), (2, ""), (3, "[1]"), (4, "{broken"), (5, '"text"'), (6, '{"new":1,"ticker":"T"}')], "seq int, value string")
    assert [(r.seq, r.event, r.status, r.new) for r in logs.log_lines(lines).orderBy("seq").collect()] == [(1, "a", "5", None), (6, None, None, "1")]
    assert logs.outer_object('x {y} {"a": "}"} z') == '{"a": "}"}' and logs.outer_object("none {") is None and logs.outer_object(None) is None


class Counting(extraction.FixedProvider):
    pass


def test_answers_are_asked_once_and_failures_are_rows(spark):
    r = extraction.keyed(spark.createDataFrame([(f"p{k}",) for k in range(60)] + [("p1",)], "prompt string"), "prompt")
    first = extraction.ask(r, Counting).cache()
    assert first.count() == 60 and first.where("unavailable").count() == first.where("error like 'HTTP 402%'").count()
    assert extraction.ask(r, Counting, first).count() == 0


def test_comparative_blocks_are_dropped_and_values_scaled(spark):
    answer = extraction.FixedProvider().complete("p0")
    df = spark.createDataFrame([("T", "x", "FY", answer), ("T", "y", None, answer), ("T", "z", "FY", "no json")], "ticker string, publication_id string, expected_type string, answer string")
    got = extraction.extracted_metrics(df).collect()
    assert {(r.publication_id, r.period_type) for r in got} == {("x", "FY"), ("y", "FY"), ("y", "H1")}
    assert all(r.value % 1000 == 0 for r in got if r.value is not None)


def test_watermark_is_strict(spark):
    found = spark.createDataFrame([("a", "T", datetime.date(2024, 1, 2)), ("b", "T", datetime.date(2024, 1, 3)), ("c", "N", datetime.date(1950, 1, 1))], "publication_id string, ticker string, publication_date date")
    marks = mart.watermarks(found.select("ticker").distinct(), found.where("publication_id = 'a'"))
    assert sorted(r.publication_id for r in mart.incremental(found, marks).collect()) == ["b", "c"]
    assert sorted(r.publication_id for r in mart.incremental(found, marks, 1).collect()) == ["a", "b", "c"]


def test_best_names_of_all_names(spark):
    sf = "/root/testdata/sf0.001"
    names = [(r.s_suppkey, r.s_name) for r in spark.read.parquet(f"{sf}/supplier.parquet").collect()]
    targets = {r.c_name for r in spark.read.parquet(f"{sf}/customer.parquet").collect()}

    def best(target):
        scored = [(-difflib.SequenceMatcher(None, target.lower().strip(), name.lower().strip()).ratio(), position, name) for position, name in names]
        return [(target, k + 1, name, position, -minus) for k, (minus, position, name) in enumerate(sorted(scored)[:3])]

    want = sorted(row for target in targets for row in best(target))
    got = registry.queries()["j14_best_names"](spark, sf)
    assert sorted(map(tuple, got.select("target", "place", "name", "position", "score").collect())) == want
    asked, all_names = spark.createDataFrame([(t,) for t in targets], "target string"), spark.createDataFrame(names, "position long, name string")
    assert sorted(map(tuple, listings.best_of_all(asked, all_names, block_rows=4).select("target", "place", "name", "position", "score").collect())) == want


def test_a_search_among_many_names_visits_few():
    names = [(k, f"Supplier#{k:09d}") for k in range(1, 20_001)]
    index = listings.NameIndex(names, 3)
    for k in (1, 777, 20_000, 123_456, 299_999):
        assert len(index.best(f"Customer#{k:09d}")) == 3
    assert index.scored < 50 and index.visited < 2_500


def test_archives_come_in_batches_bounded_by_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, f"{64 << 20}b")
    try:
        got = registry.queries()["s14_unpack"](spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get(key).rstrip("b")) <= 4 << 20 and got.where("file_hash is not null").count() > 0
    finally:
        spark.conf.set(key, before)
