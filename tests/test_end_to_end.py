"""The command line over a small corpus, incremental arrival, and the registry's contract."""

import json

import __spark_entry__ as entry
from docweave import cli
from docweave.operators.embedding import embed_sparse
from docweave.sources import facts as fa
from docweave.sources.store import Store
from docweave.streaming.incremental import index_arrivals


def test_command_line(spark, tmp_path, capsys):
    raw, store = tmp_path / "raw" / "medical", str(tmp_path / "store")
    raw.mkdir(parents=True)
    header = list(fa.COLUMNS)
    row = ["F1", "General", "Road 1", "Rome", "RM", "1", "", "", "H_COMP_1_A", "Nurses listened", "", "4", "", "", "", "", "9", "", "", "", "1/2/2024", "3/4/2024"]
    (raw / "facts.csv").write_text(",".join(header) + "\n" + ",".join(row) + "\n")
    (raw / "sites.json").write_text(json.dumps([{"name": "guide", "url": "http://h.org/guide"}]))
    run = lambda *a: cli.main(["--store", store, *a])
    run("discover", "--input", str(tmp_path / "raw"), "--root", str(tmp_path))
    docs = {r.source_type: r for r in Store(spark, store).read("documents").collect()}
    assert set(docs) == {"csv", "html"}
    assert docs["csv"].parser_version and docs["html"].parser_version is None
    html = "<h1>Insulin</h1><p>Insulin lowers glucose levels.</p><h2>Storage</h2><p>Keep insulin cold.</p>"
    pages = [(docs["html"].document_id, "medical", 1, html, "http://h.org/guide", "Guide"), (docs["html"].document_id, "medical", 2, "<div></div>", "http://h.org/empty", "")]
    spark.createDataFrame(pages, "document_id string, domain string, page_number int, html string, url string, title string").write.parquet(str(tmp_path / "pages"))
    run("parse-facts", "--path", str(raw / "facts.csv"), "--document-id", docs["csv"].document_id, "--domain", "medical")
    run("parse-pages", "--pages", str(tmp_path / "pages"))
    # A page without content is still a page; parsed documents aren't pending.
    assert Store(spark, store).read("structured_html").count() == 2
    assert {r.status for r in Store(spark, store).read("documents").collect()} == {"parsed"}
    for command in ("normalize", "chunk", "index", "index", "centroids", "stats"):
        run(command)
    done = Store(spark, store)
    assert done.read("embeddings").count() == 4
    assert [r.section_path for r in done.read("parent_sections").orderBy("metadata.section_index").collect()] == [["Insulin"], ["Storage"]]
    assert done.read("documents").filter("status = 'chunked'").count() == 1
    spark.createDataFrame([(1, "keep insulin cold.")], "query_id bigint, query string").write.parquet(str(tmp_path / "q"))
    run("query", "--questions", str(tmp_path / "q"))
    assert done.read("answers").first().answer == "Keep insulin cold. [1]"
    # A changed page keeps its chunk ids; its vectors follow the new text, and those of lost chunks go.
    changed = [(*pages[0][:3], "<h1>Insulin</h1><p>Glucagon raises glucose.</p>", *pages[0][4:])]
    spark.createDataFrame(changed, "document_id string, domain string, page_number int, html string, url string, title string").write.parquet(str(tmp_path / "pages2"))
    run("parse-pages", "--pages", str(tmp_path / "pages2"))
    for command in ("normalize", "chunk", "index"):
        run(command)
    terms = {tuple(sorted(r.terms)) for r in done.read("embeddings").collect()}
    assert done.read("embeddings").count() == 3 and ("glucagon", "glucose.", "raises") in terms
    (tmp_path / "scores.csv").write_text("domain,faithfulness,context_precision\nmedical,1.0,\nout_of_scope,0.5,NaN\n")
    run("evaluate", "--scores", str(tmp_path / "scores.csv"))
    assert "in_scope" in capsys.readouterr().out
    items = [(1, "Does glucagon raise glucose?", "Glucagon raises glucose.", "medical"), (2, "Who won?", None, "out_of_scope"), (3, "Glucose?", "Glucose", None)]
    spark.createDataFrame(items, "item_id bigint, question string, ground_truth string, domain string").write.parquet(str(tmp_path / "items"))
    run("evaluation-run", "--questions", str(tmp_path / "items"), "--limit", "2")
    first = {r.item_id: r for r in done.read("evaluation_rows").collect()}
    assert set(first) == {1, 2} and first[1].answer == "Glucagon raises glucose." and first[1].faithfulness == first[1].context_recall == 1.0
    # What is answered stays, whatever is asked for later.
    done.merge("evaluation_rows", done.read("evaluation_rows").filter("item_id = 1").selectExpr("* EXCEPT (answer)", "'kept' AS answer"), "item_id")
    run("evaluation-run", "--questions", str(tmp_path / "items"))
    after = {r.item_id: r for r in done.read("evaluation_rows").collect()}
    assert set(after) == {1, 2, 3} and after[1].answer == "kept" and after[3].domain == "unknown"
    assert "domain:unknown" in capsys.readouterr().out


def test_arrivals_are_indexed_once(spark, tmp_path):
    schema = "document_id string, element_id string, element_type string, text string, page_number int, `order` bigint, domain string, source_type string, file_name string"
    store = Store(spark, str(tmp_path / "s"))
    folder = str(tmp_path / "in")
    for name in ("a", "b"):
        rows = [(name, f"{name}:0", "heading", "# T", 1, 0, "legal", "pdf", "f"), (name, f"{name}:1", "text", f"text {name}", 1, 1, "legal", "pdf", "f")]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        index_arrivals(store, folder, schema, str(tmp_path / "c"), lambda df: embed_sparse(df, "text_content")).awaitTermination()
        assert store.read("arrived_chunks").count() == (1 if name == "a" else 2)


def test_registry_contract(spark):
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 50
    assert entry.entry(spark).columns
