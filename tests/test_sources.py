import json
import uuid

import pytest
from pyspark.sql import functions as F

from docweave.functions import ids
from docweave.functions import text as tx
from docweave.functions import vectors as vx
from docweave.operators import captions as cp
from docweave.operators import normalize as nm
from docweave.operators import rollup as ru
from docweave.plans import catalog as ca
from docweave.plans import evaluation as ev
from docweave.sources import discovery as di
from docweave.sources import facts as fa
from docweave.sources import html as ht


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_uuid5_with_any_text(spark):
    names = ["plain", "é:ü", "日本語", "", "a:b", "🙂 x"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(ids.uuid5(F.col("n"), F.lit("k"))).collect()] == [str(uuid.uuid5(uuid.NAMESPACE_URL, f"{n}:k")) for n in names]


def test_text_expressions(spark):
    lit = F.lit
    odd = "  a\x1c\x85b \t\n c "
    assert one(spark, tx.clean(lit(odd))) == " ".join(odd.split())
    assert one(spark, tx.strip(lit(odd))) == odd.strip()
    assert [one(spark, tx.heading_level(lit(t))) for t in ("# a", "### a", "####### a", "#a", "a")] == [1, 3, 1, 1, 1]
    assert one(spark, tx.clean_title(lit("##  A # b "))) == "A # b"
    assert one(spark, tx.strip_citations(lit("a [1] b [22]. [x] "))) == "a b. [x]"
    assert one(spark, tx.markdown_cell(lit(" a|b\r\nc "))) == "a\\|b  c"
    assert one(spark, tx.page_of_image(lit("x_IMG_P12_3.jpg"))) == 12 and one(spark, tx.page_of_image(lit("x.jpg"))) == 0
    assert one(spark, tx.url_name(lit("https://a.b.org/x/drugInfo.cfm?s=1"))) == "a_b_org"
    assert one(spark, tx.url_name(lit("https://a.org/x/page.html"))) == "page"
    assert one(spark, tx.safe_image_name(lit("a/b c.png"), lit(3))) == "b_c.png"
    assert one(spark, tx.fallback_caption({})) == tx.NO_CAPTION
    fields = {"section_title": lit("S"), "nearby_text_after": lit("x" * 1300), "title": lit(" ")}
    assert one(spark, tx.fallback_caption(fields)) == "Image context: Section: S Nearby text after: " + "x" * 1200
    assert one(spark, tx.caption_prompt(fields)).endswith("Document context:\nSection: S\nNearby text after: " + "x" * 1200)
    assert one(spark, tx.source_label(lit(""), lit("f"), lit("d"))) == "f | domain=d"


def test_token_windows_cover_everything(spark):
    for n, size, overlap in [(10, 10, 3), (11, 10, 3), (40, 10, 3), (12, 5, 5), (9, 4, 0)]:
        words = [f"w{i}" for i in range(n)]
        df = spark.createDataFrame([(words,)], "w array<string>")
        got = df.select(tx.text_pieces(F.lit("whole"), F.col("w"), size, overlap)).first()[0]
        if n <= size:
            assert got == ["whole"]
        else:
            step = max(size - overlap, 1)
            assert got == [" ".join(words[s : s + size]) for s in range(0, n, step)]


def test_hash_and_box_expressions(spark):
    pairs = [("ffffffffffffffff", "fffffffffffffff0"), ("8000000000000000", "0"), ("1", "1")]
    for a, b in pairs:
        got = one(spark, vx.hamming(vx.hash_from_hex(F.lit(a)), vx.hash_from_hex(F.lit(b))))
        assert got == bin(int(a, 16) ^ int(b, 16)).count("1")
    box = lambda *v: [F.lit(float(x)) for x in v]
    assert one(spark, vx.iou(*box(0, 0, 2, 2), *box(1, 0, 2, 2))) == pytest.approx(1 / 3)
    assert one(spark, vx.iou(*box(0, 0, 0, 0), *box(0, 0, 0, 0))) == 0.0


HTML = """<html><head><title>x</title><style>p{}</style></head><body><p>lead <i>in</i></p>
<h1>One</h1><p>a<p>b <b>c<br></p><script>var t="</p>";</script>
<h3>Deep</h3><ul><li>x<li>y <p>inner</p></ul><table><tr><th>H|1</th><th>H2</th></tr><tr><td>v</td></tr></table>
<h2></h2><img src="/i.png" alt=" the  alt "><img alt="none"><blockquote>q <p>r</p></blockquote><h2>Two &amp; 3</h2></body></html>"""


def test_html_elements_and_sections(spark):
    df = spark.createDataFrame([("d", 1, HTML, "http://h.org/a/", "T")], "document_id string, page_number int, html string, url string, title string")
    rows = ht.extract_pages(df).orderBy("sequence").collect()
    assert [(r.type, r.text) for r in rows if r.type != "image"] == [
        ("text", "lead in"), ("heading", "One"), ("text", "a"), ("text", "b c"), ("heading", "Deep"), ("text", "x y inner"),
        ("table", "H|1 H2 v"), ("text", "q r"), ("heading", "Two & 3"),
    ]
    assert [r.sequence for r in rows] == [1, 2, 3, 4, 5, 6, 7, 9, 11, 12]
    table, picture = [r for r in rows if r.type == "table"][0], [r for r in rows if r.type == "image"][0]
    assert table.table_markdown == "| H\\|1 | H2 |\n| --- | --- |\n| v |  |" and table.table_html.startswith("<table>")
    assert picture.image_url == "http://h.org/i.png" and picture.alt_text == "the alt"
    page_id = str(uuid.uuid5(uuid.NAMESPACE_URL, "http://h.org/a/:1"))
    assert rows[0].element_id == str(uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}:1:p"))
    nested = ht.structured_pages(ht.extract_pages(df))
    sections = nested.first().sections
    assert [(s.heading, s.heading_level, len(s.elements)) for s in sections] == [("T", 0, 1), ("One", 1, 3), ("Deep", 3, 5), ("Two & 3", 2, 1)]
    flat = nm.normalize_html(nested.withColumn("domain", F.lit("legal"))).orderBy("order").collect()
    # A section heading comes once for the section and once as its first element; images have no text.
    assert [r.text for r in flat] == ["lead in", "One", "One", "a", "b c", "Deep", "Deep", "x y inner", "H|1 H2 v", "q r", "Two & 3", "Two & 3"]
    assert flat[3].element_id == "d:p1:00003"
    two = df.union(df.withColumn("page_number", F.lit(2)))
    for block_rows in (1, 100):
        pages = ht.structured_pages(ht.extract_pages(two)).withColumn("domain", F.lit("legal"))
        longer = nm.normalize_html(pages, block_rows).orderBy("order").collect()
        assert [r.order for r in longer] == list(range(24)) and longer[12].element_id == "d:p2:00012"
    assert tuple(ht.crawl_counts(ht.structured_pages(ht.extract_pages(two))).first()) == ("d", 2, 8)
    marked = df.selectExpr("document_id", "explode(sequence(1, 5)) AS page_number", "url", "'m' AS markdown")
    assert ht.joined_pages(marked.selectExpr("document_id", "page_number", "'b' || page_number AS block"), 2).first().markdown == "\n\n---\n\n".join(f"b{i}" for i in range(1, 6))
    assert ht.combined_markdown(marked).first().markdown.startswith("# Crawled Page 1\nSource URL: http://h.org/a/\n\nm\n\n---\n\n# Crawled Page 2")


def facts_row(n, facility="F1", measure="H_COMP_1_A", **kw):
    base = dict.fromkeys(fa.COLUMNS.values())
    base |= {"facility_id": facility, "facility_name": "Gen|eral", "measure_id": measure, "survey_start_date": "1/2/2024", "survey_end_date": "12/31/2024"}
    base |= kw
    return ("doc", "medical", "f.csv", *base.values(), n)


FACTS = "document_id string, domain string, file_name string, " + ", ".join(f"{c} string" for c in fa.COLUMNS.values()) + ", source_row_number bigint"


@pytest.mark.parametrize("block_rows", [2, 1000])
def test_rollup(spark, block_rows):
    rows = [
        facts_row(2, question="Q|1", star_rating="4", city="Rome"), facts_row(3, measure="H_CLEAN_HSP", answer_percent="71"),
        facts_row(4, question="Q2", star_rating="Not Applicable", answer_percent="N/A", linear_mean_value="88"), facts_row(5, facility="F2", measure="H_QUIET_X"),
        facts_row(6, facility="F2", measure="H_QUIET_X", answer_percent="5"),
    ]
    df = spark.createDataFrame(rows, FACTS)
    docs = {(r.facility_id, r.category): r for r in ru.category_docs(df, block_rows).collect()}
    nurse = docs["F1", "nurse_communication"]
    assert nurse.retrieval_text.split("\n") == [
        "Hospital: Gen|eral", "Facility ID: F1", "Location: Rome", "Category: Nurse communication", "Survey period: 1/2/2024 to 12/31/2024",
        "Completed surveys: Not available", "Survey response rate: Not available%", "", "- Q|1: 4", "- Q2: 88",
    ]
    assert nurse.table_markdown.split("\n")[2] == "| H_COMP_1_A | Q\\|1 | star rating | 4 |"
    assert nurse.measure_ids == ["H_COMP_1_A"] * 2 and nurse.source_row_numbers == [2, 4]
    assert nurse.summary["H_COMP_1_A"].result == "88"
    quiet = docs["F2", "hospital_environment"]
    assert quiet.retrieval_text.endswith("- H_QUIET_X: Not available\n- H_QUIET_X: 5%")
    profile = {r.facility_id: r for r in ru.facility_profiles(df, block_rows).collect()}["F1"]
    assert "Address: None, Rome, None None" in profile.retrieval_text
    assert profile.retrieval_text.endswith("Available HCAHPS categories:\n- Nurse communication: 1 measures\n- Hospital environment: 1 measures")
    assert profile.metadata.source_row_numbers == [2, 3, 4] and str(profile.survey_start_date) == "2024-01-02"
    counts = ru.rollup_counts(df, ru.facility_profiles(df), ru.category_docs(df)).first()
    assert (counts.row_count, counts.hospital_profile_count, counts.hospital_category_doc_count) == (5, 2, 3)


def test_rollup_rejects_bad_input(spark):
    with pytest.raises(Exception, match="Unmapped"):
        ru.category_docs(spark.createDataFrame([facts_row(2, measure="X")], FACTS)).collect()
    split = [facts_row(2), facts_row(3, facility="F2"), facts_row(4)]
    with pytest.raises(Exception, match="not grouped"):
        ru.facility_profiles(spark.createDataFrame(split, FACTS)).collect()


def test_facts_scan_numbers_rows(spark, tmp_path):
    path = tmp_path / "facts.csv"
    lines = [",".join(f'"{h}"' for h in fa.COLUMNS)]
    for i in range(500):
        values = [f"F{i}", "N/A" if i % 2 else " name ", *["" for _ in range(18)], "3/4/2024", "12/31/2024"]
        lines.append(",".join(values))
    path.write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = fa.read_rows(spark, str(path), "doc", "medical")
        assert rows.rdd.getNumPartitions() > 3
        found = {r.facility_id: r for r in fa.facts(rows).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert all(found[f"F{i}"].source_row_number == i + 2 for i in range(500))
    assert found["F1"].facility_name is None and found["F2"].facility_name == "name" and str(found["F2"].survey_start_date) == "2024-03-04"


def test_captions(spark):
    images = spark.createDataFrame(
        [(1, "a", True, "S"), (2, None, True, None), (3, "a", False, None), (4, "b", True, None), (5, "c", True, "S"), (6, "c", True, "T")],
        "i int, sha string, path_ok boolean, section_title string",
    )
    cache = spark.createDataFrame([("m", "a", " old  text "), ("m", "b", " "), ("x", "b", "other")], "model string, sha string, text string")
    fields = {"section_title": F.col("section_title")}
    got = {r.i: (r.status, r.caption) for r in cp.caption_images(images, cache, "m", fields).collect()}
    assert got[1] == ("cached", "old text") and got[2] == ("missing_image", tx.NO_CAPTION) and got[3][0] == "invalid_path"
    assert got[4] == ("missing_api_key", tx.NO_CAPTION) and got[5] == ("missing_api_key", "Image context: Section: S")
    model = lambda sha, prompt: F.when(sha == "c", F.concat(sha, F.lit(" new")))
    made = cp.caption_images(images, cache, "m", fields, model)
    got = {r.i: (r.status, r.caption) for r in made.collect()}
    assert got[4] == ("generation_failed", tx.NO_CAPTION) and got[5] == got[6] == ("generated", "c new")
    assert cp.refreshed_cache(cache, made, "m").count() == 4


def test_pdf_elements_and_splice(spark):
    page = {"page_number": 3, "items": [
        {"type": "heading", "md": "# Top", "bbox": [{"y": 1.0}]}, {"type": "footer", "md": "no"}, {"type": "text", "value": " body  one "},
        {"type": "table", "md": "|t|", "bbox": [{"y": 50.0}]}, {"type": "text", "md": "", "value": "tail", "bbox": [{"y": 90.0}]},
    ]}
    schema = "document_id string, domain string, pages array<struct<page_number:int, items:array<struct<type:string, md:string, value:string, bbox:array<struct<y:double>>>>>>"
    docs = spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps({"document_id": "d", "domain": "legal", "pages": [page]})]))
    content = nm.pdf_content(docs)
    images = spark.createDataFrame(
        [("d", "legal", 0, 3, 1, "img_p3_1.png", 0.0, 60.0), ("d", "legal", 0, 3, 2, "img_p3_2.png", 0.0, 60.0), ("d", "legal", 0, 3, 3, "img_p3_0.png", 0.0, 0.5)],
        "document_id string, domain string, page int, page_number int, idx bigint, filename string, x double, y double",
    )
    found = nm.image_context(content, images)
    ctx = {r.filename: r for r in found.collect()}
    assert (ctx["img_p3_1.png"].below, ctx["img_p3_1.png"].section_title, ctx["img_p3_1.png"].nearby_text_before) == (3, "# Top", "body one")
    assert (ctx["img_p3_1.png"].nearby_text_after, ctx["img_p3_1.png"].nearby_table_markdown) == ("tail", "|t|")
    assert (ctx["img_p3_0.png"].below, ctx["img_p3_0.png"].section_title, ctx["img_p3_0.png"].nearby_table_markdown) == (1, "", None)
    for block_rows in (1, 100):
        out = nm.normalize_pdf(content, found.withColumn("text", F.lit("pic")), block_rows).orderBy("order").collect()
        assert [r.element_id for r in out] == ["d:p3:00000", "d:p3:img_p3_0", "d:p3:00002", "d:p3:00003", "d:p3:img_p3_1", "d:p3:img_p3_2", "d:p3:00006"]


def test_facts_go_by_header_and_are_never_torn(spark, tmp_path):
    header = ["Extra", *reversed(fa.COLUMNS)]
    lines = []
    for i in range(40):
        values = {"Facility ID": f"F{i}", "Facility Name": f'"Name ""{i}""\nline, two"' if i % 3 == 0 else f"Name {i}"}
        lines.append(",".join(["x", *(values.get(h, "") for h in reversed(fa.COLUMNS))]))
    path = tmp_path / "facts.csv"
    path.write_text("\ufeff" + ",".join(header) + "\n" + "\n".join(lines) + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        rows = fa.read_rows(spark, str(path), "d", "medical").orderBy("source_row_number").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.facility_id, r.source_row_number) for r in rows] == [(f"F{i}", i + 2) for i in range(40)]
    assert rows[0].facility_name == 'Name "0"\nline, two' and rows[1].facility_name == "Name 1"
    path.write_text("Facility ID,Facility Name\n1,a\n")
    with pytest.raises(ValueError, match="columns missing"):
        fa.read_rows(spark, str(path), "d", "medical")


def test_discovery(spark, tmp_path):
    for name in ("legal/A.PDF", "legal/b.csv", "legal/c.txt", "legal/deep/x.pdf"):
        (tmp_path / "raw" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / name).write_text("abc")
    (tmp_path / "raw" / "legal" / "list.json").write_text(json.dumps([{"name": "N", "firecrawl_config": {"url": "http://X.org/Y"}}, {"url": "http://z.org"}, {"other": 1}]))
    (tmp_path / "raw" / "legal" / "one.json").write_text(json.dumps({"url": "http://w.org", "firecrawl_mode": "scrape", "maxDepth": 3, "note": "a}b"}))
    files = {r.file_name: r for r in di.local_files(spark, str(tmp_path / "raw"), str(tmp_path)).collect()}
    assert set(files) == {"A.PDF", "b.csv"} and files["A.PDF"].file_path == "raw/legal/A.PDF"
    assert files["A.PDF"].document_id == str(uuid.uuid5(uuid.NAMESPACE_URL, "legal:pdf:raw/legal/a.pdf")) and files["A.PDF"].metadata == '{"file_size_bytes":3}'
    pages = {r.file_path: r for r in di.crawl_sources(spark, str(tmp_path / "raw"), str(tmp_path)).collect()}
    assert {u: r.file_name for u, r in pages.items()} == {"http://X.org/Y": "N", "http://z.org": "list", "http://w.org": "one"}
    kept = json.loads(pages["http://w.org"].metadata)
    assert kept["firecrawl_mode"] == "scrape" and kept["firecrawl_config"] == {"url": "http://w.org", "firecrawl_mode": "scrape", "maxDepth": 3, "note": "a}b"}
    assert json.loads(pages["http://X.org/Y"].metadata)["firecrawl_config"] == {"url": "http://X.org/Y"}
    (tmp_path / "none" / "legal").mkdir(parents=True)
    assert di.crawl_sources(spark, str(tmp_path / "none"), str(tmp_path)).count() == 0
    assert di.local_files(spark, str(tmp_path / "none"), str(tmp_path)).count() == 0
    assert set(di.SUPPORTED_SUFFIXES) == {".pdf", ".html", ".csv"}


def test_catalog(spark):
    meta = "struct<job:struct<job_id:string,api_key_alias:string,tier:string,version:string>,parse_outputs:map<string,string>,parse_error:string>"
    schema = f"document_id string, domain string, file_name string, source_type string, status string, metadata {meta}"
    docs = spark.createDataFrame([("1", "d", "a", "pdf", "parsed", (None, {"k": "v"}, None)), ("2", "d", "b", "csv", "discovered", (None, None, None))], schema)
    again = spark.createDataFrame([("1", "e", "A", "pdf", None, (None, None, None)), ("3", "d", "c", "html", None, (None, None, None))], schema)
    merged = {r.document_id: r for r in ca.upsert_documents(docs, again.drop("status")).collect()}
    assert merged["1"].status == "parsed" and merged["1"].domain == "e" and merged["1"].metadata.parse_outputs is None
    assert merged["3"].status == "discovered" and merged["2"].file_name == "b"
    failed = ca.mark_failed(docs, spark.createDataFrame([("2", "x" * 3000)], "document_id string, error string"))
    assert {r.document_id: (r.status, r.n) for r in failed.selectExpr("document_id", "status", "length(metadata.parse_error) AS n").collect()} == {"1": ("parsed", None), "2": ("failed", 2000)}
    jobs = ca.save_jobs(docs, spark.createDataFrame([("2", "j", "k2")], "document_id string, job_id string, api_key_alias string"))
    workers = {r.document_id: r.worker for r in ca.assign_workers(jobs, ["k1", "k2"]).collect()}
    assert workers["2"] == "k2" and workers["1"] in ("k1", "k2")
    with pytest.raises(Exception, match="unknown worker"):
        ca.assign_workers(jobs, ["k1"]).collect()
    files = spark.createDataFrame([("1", "md", 5), ("1", "json", 5), ("2", "md", 5), ("2", "json", 0)], "document_id string, output string, size int")
    assert [r.document_id for r in ca.without_outputs(docs, files, ["md", "json"]).collect()] == ["2"]
    rows = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new")], "key string, n int, v string")
    assert ca.latest(rows, ["key"], "n").first().v == "new"
    assert {r.document_id: r.status for r in ca.set_status(docs, spark.createDataFrame([("2", "chunked")], "document_id string, status string")).collect()}["2"] == "chunked"
    with pytest.raises(Exception, match="Unsupported"):
        nm.check_values(docs, "domain", nm.DOMAINS).collect()


def test_evaluation_slices(spark):
    nan = float("nan")
    rows = [("a", 1.0, nan), ("a", 0.5, 0.25), ("b", 0.33335, nan), ("out_of_scope", 0.0, nan)]
    df = spark.createDataFrame(rows, "domain string, faithfulness double, context_precision double")
    got = {r.slice: r for r in ev.slice_scores(df).collect()}
    assert got["overall"]["count"] == 4 and got["overall"].faithfulness == 0.4583 and got["overall"].context_precision == 0.25
    assert got["in_scope"].faithfulness == 0.6111 and got["domain:b"].context_precision is None
    assert {r.metric: (r.scored, r.total) for r in ev.coverage(df).collect()} == {"faithfulness": (4, 4), "context_precision": (1, 4)}
