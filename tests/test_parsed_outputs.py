"""Structured parser outputs: bad records, failed documents, the PDF path up to elements, and raw crawls."""

import json
import os

from pyspark.sql import functions as F

from docweave import cli
from docweave.operators import normalize as nm
from docweave.plans import catalog as ca
from docweave.plans import corpus
from docweave.sources import html as ht
from docweave.sources import structured as st
from docweave.sources.store import Store


def page(number, *items):
    return {"page_number": number, "items": list(items)}


def test_bad_records_are_named_and_lose_nothing_else(spark):
    files = {
        "a": {"pages": [page(3, {"type": "heading", "md": "# T", "bbox": [{"y": 1}]}, {"type": "text", "value": 5, "bbox": {"y": 3}}, "loose"), {"items": []}, page(4)]},
        "b": {"pages": [page(1, {"type": "text", "md": "é", "bbox": [{"y": "7.5"}]}), {"page_number": 2, "items": "no"}]},
        "c": [], "d": {"pages": {}}, "e": {"pages": []}, "f": {"pages": [page(9)], "more": {"x": 1}},
    }
    texts = [(k, json.dumps(v)) for k, v in files.items()] + [("g", '{"pages": [1'), ("h", None), ("i", "")]
    pages, rejected = st.pdf_pages(spark.createDataFrame(texts, "path string, text string"))
    got = {(r.path, r.page): (r.page_number, [(i.type, i.md, i.value, i.bbox and i.bbox[0].y) for i in r["items"]]) for r in pages.collect()}
    assert got == {
        ("a", 0): (3, [("heading", "# T", None, 1.0), ("text", None, "5", None)]), ("a", 2): (4, []),
        ("b", 0): (1, [("text", "é", None, 7.5)]), ("f", 0): (9, []),
    }
    bad = {(r.path, r.page, r.item): r.error for r in rejected.collect()}
    assert bad == {
        ("a", 0, 2): "item is no object", ("a", 1, None): "page without page_number", ("b", 1, None): "items is no list",
        ("c", None, None): "no list of pages", ("d", None, None): "no list of pages", ("g", None, None): "not JSON",
        ("h", None, None): "not JSON", ("i", None, None): "not JSON",
    }
    first = {r.path: (r.error, r.records) for r in st.first_errors(rejected).collect()}
    assert first["a"] == ("page 1, item 3: item is no object", 2) and first["c"] == ("no list of pages", 1)


def test_a_text_is_read_in_one_pass(spark):
    loose = ["{torn", None, 5, "  {}", [], {"type": "text", "bbox": {"y": 1}}]
    texts = [("a", json.dumps({"pages": [page(1, *loose), None, "x", {"page_number": 2}, {"page_number": 3, "items": None}]})), ("e", '{"pages": []}'), ("n", None), ("t", '{"pages": [{')]
    files = spark.createDataFrame(texts, "path string, text string")
    pages, rejected = st.pdf_pages(files)
    leaves = lambda df: df._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert leaves(rejected) == 1 and leaves(pages) == 1
    read = str(pages._jdf.queryExecution().optimizedPlan().toString())
    assert read.count("array<struct<y:string>>") <= 1 and read.count("Filter") == 1
    got = {(r.path, r.page): (r.page_number, [(i.type, i.bbox) for i in r["items"]]) for r in pages.collect()}
    assert got == {("a", 0): (1, [(None, None), (None, None), ("text", None)]), ("a", 3): (2, []), ("a", 4): (3, [])}
    bad = sorted((r.path, -1 if r.page is None else r.page, -1 if r["item"] is None else r["item"], r.error) for r in rejected.collect())
    assert bad == [
        *(("a", 0, n, "item is no object") for n in (1, 2, 4)), *(("a", n, -1, "page without page_number") for n in (1, 2)),
        ("n", -1, -1, "not JSON"), ("t", -1, -1, "not JSON"),
    ]


def test_image_lists(spark):
    entries = [{"filename": "img_p2_1.png", "bbox": {"x": 1, "h": 4.5}}, "odd", {"bbox": {}}, {"filename": "page_12_image.jpg", "category": "layout", "bbox": None}]
    texts = [("a", json.dumps({"images_content_metadata": {"images": entries}})), ("b", json.dumps({"images_content_metadata": None})), ("c", "{")]
    rows, bad = st.pdf_images(spark.createDataFrame(texts, "path string, text string"))
    got = [(r.path, r.idx, r.filename, r.page, r.x, r.y, r.w, r.h, r.category) for r in rows.orderBy("idx").collect()]
    assert got == [("a", 0, "img_p2_1.png", 2, 1.0, 0.0, 0.0, 4.5, "embedded"), ("a", 3, "page_12_image.jpg", 12, 0.0, 0.0, 0.0, 0.0, "layout")]
    assert {(r.path, r.item, r.error) for r in bad.collect()} == {("a", 1, "image is no object"), ("c", None, "not JSON")}


def test_pdf_outputs_become_elements(spark, tmp_path, capsys):
    raw, parsed, images = tmp_path / "raw" / "legal", tmp_path / "parsed" / "legal" / "pdf", tmp_path / "images" / "legal"
    for folder in (raw, parsed, images / "A"):
        folder.mkdir(parents=True)
    for name in "ABCD":
        (raw / f"{name}.PDF").write_text("%PDF")
    text = lambda md, y: {"type": "text", "md": md, "bbox": [{"y": y}]}
    whole = {"pages": [page(1, {"type": "heading", "md": "# Top", "bbox": [{"y": 0}]}, text("one", 10.0), text("two", 90.0)), page(2), page(3, text("three", 5.0))]}
    box = {"x": 0, "y": 50, "w": 100, "h": 100}
    names = ["img_p1_9.png", "img_p1_2.png", "img_p2_1.png", "img_p3_lost.png", "img_p7_1.png", "img_p1_tiny.png", "img_p3_copy.png"]
    listed = [{"filename": n, "bbox": box | ({"x": 500} if n == "img_p1_2.png" else {}) | ({"w": 3} if "tiny" in n else {})} for n in names]
    for n in names:
        if "lost" not in n:
            (images / "A" / n).write_bytes(b"img_p1_9.png" if "copy" in n else n.encode())
    put = lambda name, kind, value: (parsed / f"{name}.{kind}.json").write_text(value if isinstance(value, str) else json.dumps(value))
    put("A", "structured", whole), put("A", "images", {"images_content_metadata": {"images": listed}})
    put("B", "structured", '{"pages": [{"page_number": 1, "items": [{"type"'), put("B", "images", {})
    put("C", "structured", {"pages": [page(1, text("c", 1))]})
    put("X", "structured", whole), put("X", "images", {})  # no document of this name
    root = str(tmp_path / "store")
    run = lambda *a: cli.main(["--store", root, *a])
    run("discover", "--input", str(tmp_path / "raw"), "--root", str(tmp_path))
    run("parse-pdf", "--parsed", str(tmp_path / "parsed"), "--images", str(tmp_path / "images"))
    store = Store(spark, root)
    docs = {r.file_name: r for r in store.read("documents").collect()}
    assert {n: r.status for n, r in docs.items()} == {"A.PDF": "parsed", "B.PDF": "failed", "C.PDF": "failed", "D.PDF": "discovered"}
    assert docs["B.PDF"].metadata.parse_error == "not JSON" and docs["C.PDF"].metadata.parse_error == "image list is missing"
    assert json.loads(docs["A.PDF"].metadata.source) == {"file_size_bytes": 4}
    assert [r.file_name for r in ca.recoverable_documents(store.read("documents")).collect()] == ["A.PDF"]
    assert [r.file_name for r in ca.pending_documents(store.read("documents"), "pdf").collect()] == ["B.PDF", "C.PDF", "D.PDF"]
    reasons = {r.filename: r.reason for r in store.read("pdf_images").collect()}
    assert reasons == {n: None for n in names} | {"img_p3_lost.png": "missing_on_disk", "img_p1_tiny.png": "decorative_dimensions", "img_p3_copy.png": "exact_duplicate"}

    run("normalize")
    elements = store.read("elements").orderBy("order").collect()
    a = docs["A.PDF"].document_id
    # Images of one height go by x, those of one place by the list; a page without content keeps its image; page 7 is none.
    assert [r.element_id for r in elements] == [f"{a}:p1:00000", f"{a}:p1:00001", f"{a}:p1:img_p1_9", f"{a}:p1:img_p1_2", f"{a}:p1:00004", f"{a}:p2:img_p2_1", f"{a}:p3:00006"]
    assert elements[2].text == "Image context: Section: # Top Nearby text before: one Nearby text after: two"
    assert elements[5].text == "Image element without an available generated caption."

    # Captions are made once per content, a batch at a time; what fails is asked for again.
    def client():
        tried = {}

        def ask(sha, prompt):
            tried[sha] = tried.get(sha, 0) + 1
            if "Nearby text before: one" in prompt and tried[sha] < 3:
                raise TimeoutError
            return "  a   chart " if "Nearby" in prompt else ""

        return ask

    kept = {r.filename: r.sha for r in store.read("pdf_images").filter("reason IS NULL").collect()}
    assert set(kept) == {"img_p1_9.png", "img_p1_2.png", "img_p2_1.png", "img_p7_1.png"}
    assert corpus.caption(store, "m", client, batch_rows=2, pause=0.0) == {"generated": 2, "generation_failed": 1}
    assert {(r.model, r.sha, r.text) for r in store.read("captions").collect()} == {("m", kept[n], "a chart") for n in ("img_p1_9.png", "img_p1_2.png")}
    assert corpus.caption(store, "m", lambda: lambda sha, prompt: "late", pause=0.0) == {"generated": 1, "generation_failed": 0}
    texts = {r.element_id.split(":")[-1]: r.text for r in corpus.normalize(store, "m").filter("element_type = 'image'").collect()}
    assert texts == {"img_p1_9": "a chart", "img_p1_2": "a chart", "img_p2_1": "late"}
    run("normalize")

    # Mended outputs are picked up; what is parsed stays as it is.
    put("B", "structured", {"pages": [page(1, text("mended", 1))]}), put("C", "images", {})
    before = {os.path.join(d, f) for d, _, fs in os.walk(os.path.join(root, "pdf_content")) for f in fs if f.endswith(".parquet")}
    assert corpus.parse_pdf(store, str(tmp_path / "parsed"), str(tmp_path / "images")) == {"parsed": 2, "failed": 0}
    after = {os.path.join(d, f) for d, _, fs in os.walk(os.path.join(root, "pdf_content")) for f in fs if f.endswith(".parquet")}
    assert before <= after and {r.status for r in store.read("documents").filter("file_name <> 'D.PDF'").collect()} == {"parsed"}
    run("normalize")
    assert {r.text for r in store.read("elements").filter("element_type = 'text'").collect()} == {"one", "two", "three", "mended", "c"}
    run("recover")
    assert "structured_json_path" in capsys.readouterr().out


def test_merge_writes_only_touched_partitions(spark, tmp_path):
    store = Store(spark, str(tmp_path))

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(tmp_path / "t") for f in fs if f.endswith(".parquet")}

    rows = spark.range(400).select(
        F.concat(F.lit("d"), (F.col("id") % 50).cast("string")).alias("document_id"), F.col("id").alias("v"), F.when(F.col("id") % 2 == 0, "a/b").otherwise("c").alias("domain")
    )
    store.merge("t", rows, partition_by=("domain",), buckets=16)
    first = files()
    new = spark.createDataFrame([("d3", -1, "z"), ("n", 1, None)], "document_id string, v long, domain string")
    gone = spark.createDataFrame([("d7",), ("nobody",)], "document_id string")
    for _ in range(2):  # again, as a repeated job would
        store.merge("t", new, gone=gone, partition_by=("domain",))
        got = {(r.document_id, r.v, r.domain) for r in store.read("t").collect()}
        assert got == {(f"d{i % 50}", i, "a/b" if i % 2 == 0 else "c") for i in range(400) if i % 50 not in (3, 7)} | {("d3", -1, "z"), ("n", 1, None)}
    left = files()
    kept = {f for f in first if left.get(f) == first[f]}
    touched = {f.split("_bucket16=")[1].split("/")[0] for f in set(first) - kept}
    assert len(touched) <= 4 and all(f.split("_bucket16=")[1].split("/")[0] in touched for f in set(left) - kept)
    store.merge("t", new.limit(0), gone=store.read("t").select("document_id").distinct(), partition_by=("domain",))
    assert store.read("t").count() == 0 and store.read("t").columns == ["document_id", "v", "domain"]
    store.merge("t", new)
    assert store.read("t").count() == 2


def test_raw_crawls(spark, tmp_path):
    folder = tmp_path / "legal" / "html"
    folder.mkdir(parents=True)
    crawl = {"data": [
        {"html": "<h1>A</h1><p>x</p><h3>B</h3><p>y</p><h2>C</h2><h1>D</h1>", "metadata": {"sourceURL": "http://a", "title": "T", "statusCode": 200, "language": "en", "description": "d"}, "links": ["http://b"], "markdown": "# A"},
        {"raw_html": "", "metadata": None},
    ]}
    (folder / "site.raw.json").write_text(json.dumps(crawl))
    (folder / "none.raw.json").write_text('{"data": []}')
    (folder / "odd.raw.json").write_text('{"data": [{"html": "<p>fine</p>"}, 7]}')
    store = Store(spark, str(tmp_path / "store"))
    names = [(n, "legal", n, "html", "discovered") for n in ("site", "none", "odd")]
    docs = spark.createDataFrame(names, "document_id string, domain string, file_name string, source_type string, status string")
    store.merge("documents", docs.withColumns({"metadata": F.lit(None).cast(corpus.OUTCOME), "updated_at": F.current_timestamp()}).withColumn("metadata", F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in docs.select(F.lit(None).cast(corpus.OUTCOME).alias("m")).schema["m"].dataType.fields))))
    assert corpus.parse_crawl(store, str(tmp_path)) == {"parsed": 1, "failed": 2}
    got = {r.document_id: (r.status, r.metadata.parse_error) for r in store.read("documents").collect()}
    assert got == {"site": ("parsed", None), "none": ("failed", "the crawl returned no pages"), "odd": ("failed", "page 2: page is no object")}
    pages = store.read("structured_html").orderBy("page_number").collect()
    assert [(r.page_number, r.title, r.status_code, r.language, r.description, r.links, len(r.sections)) for r in pages] == [(1, "T", "200", "en", "d", ["http://b"], 4), (2, "Crawled page 2", None, None, None, [], 0)]
    assert [s.section_path for s in pages[0].sections] == [["A"], ["A", "B"], ["A", "C"], ["D"]]
    # Stored as structured JSON and read again, a page is the same.
    text = json.dumps({"pages": [json.loads(x) for x in store.read("structured_html").toJSON().collect()]})
    again, rejected = st.html_pages(spark.createDataFrame([("p", text)], "path string, text string"))
    assert rejected.count() == 0
    flat = lambda rows: {(r.element_id, r.text) for r in nm.normalize_html(rows.withColumns({"document_id": F.lit("d"), "domain": F.lit("legal")})).collect()}
    assert flat(again) == flat(store.read("structured_html")) != set()


def test_a_page_the_parser_rejects_fails_its_document_only(spark, tmp_path, monkeypatch):
    rows = [("good", "legal", 1, "<p>fine</p>", "u", "t"), ("bad", "legal", 1, "<p>x</p>", "u", "t"), ("bad", "legal", 2, "<![bogus", "u", "t")]
    pages = spark.createDataFrame(rows, "document_id string, domain string, page_number int, html string, url string, title string")
    found = {(r.document_id, r.page_number): r.error for r in ht.parsed_pages(pages).collect()}
    assert set(found) == {("good", 1), ("bad", 1), ("bad", 2)} and found["good", 1] is None
    if found["bad", 2] is not None:
        store = Store(spark, str(tmp_path))
        _, counts = corpus.parse_pages(store, pages)
        assert counts == {"parsed": 1, "failed": 1} and [r.document_id for r in store.read("structured_html").collect()] == ["good"]


def test_section_paths_over_blocks(spark):
    import random

    rng = random.Random(6)
    rows, expected = [], {}
    for p in range(20):
        stack = []
        for n in range(rng.randint(1, 60)):
            level = rng.choice([0] if n == 0 and p % 2 else [1, 2, 3, 4, 5, 6])
            title = f"t{p}.{n}"
            if level:
                stack = [x for x in stack if x[0] < level] + [(level, title)]
            rows.append(("d", p, "p", n, title, level))
            expected[p, n] = [x[1] for x in stack] if level else [title]
    df = spark.createDataFrame(rows, "document_id string, page_number int, page_id string, nth int, heading string, heading_level int")
    for block in (4, 1000):
        assert {(r.page_number, r.nth): r.section_path for r in ht.section_paths(df, block=block).collect()} == expected
