"""Stages of the corpus build; every stage reads stored tables and writes the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.operators import captions as cp
from docweave.operators import chunking as ch
from docweave.operators import embedding as em
from docweave.operators import normalize as nm
from docweave.operators import rollup as ru
from docweave.operators import triage as tr
from docweave.operators.centroids import domain_centroids
from docweave.plans import catalog as ca
from docweave.session import cut_lineage
from docweave.sources import discovery as di
from docweave.sources import facts as fa
from docweave.sources import html as ht
from docweave.sources import structured as st
from docweave.sources.store import Store

# What a stage adds to the metadata of a document; the discovered metadata stays a JSON text.
OUTCOME = "struct<source:string,job:struct<job_id:string,api_key_alias:string,tier:string,version:string>,parse_outputs:map<string,string>,parse_error:string>"


def discover(store: Store, input_dir: str, root: str) -> DataFrame:
    """Files and manifest entries -> ``documents``; known documents keep their status."""
    spark = store.spark
    # A url listed twice is one document; its last entry describes it.
    listed = di.crawl_sources(spark, input_dir, root)
    entries = ca.latest(listed, ["document_id"], F.struct("listed_in", "position")).drop("listed_in", "position")
    found = di.with_parser_version(di.local_files(spark, input_dir, root).unionByName(entries))
    null = F.lit(None)
    outcome = F.struct(F.col("metadata").alias("source"), null.alias("job"), null.alias("parse_outputs"), null.alias("parse_error")).cast(OUTCOME)
    found = found.withColumns({"metadata": outcome, "updated_at": F.current_timestamp()})
    if store.exists("documents"):
        known = store.read("documents")
        merged = ca.upsert_documents(known.join(found.select("document_id"), "document_id", "left_semi"), found)
    else:
        merged = found.withColumn("status", F.lit("discovered"))
    return store.merge("documents", merged)


def _settle(store: Store, outcomes: DataFrame, stage: str) -> dict[str, int]:
    """Write what became of documents (``document_id, outputs, error``) to the document table: failed where there is an
    error, else parsed. Returns the counts of both, taken while the rows are written."""
    counts = Observation(stage)
    seen = outcomes.observe(
        counts, F.count_if(F.col("error").isNull()).alias("parsed"), F.count_if(F.col("error").isNotNull()).alias("failed")
    )
    seen = cut_lineage(seen)
    if store.exists("documents"):
        known = store.read("documents").join(seen.select("document_id"), "document_id", "left_semi")
        good, bad = seen.filter("error IS NULL"), seen.filter("error IS NOT NULL")
        changed = ca.mark_failed(ca.mark_parsed(known, good.select("document_id", "outputs")), bad.select("document_id", "error"))
        store.merge("documents", changed.withColumn("updated_at", F.current_timestamp()))
    return counts.get


def parse_facts(store: Store, path: str, document_id: str, domain: str) -> DataFrame:
    """One facts CSV -> ``facts``, ``profiles`` and ``category_docs``; an earlier import of it is replaced.

    A file that can't be read marks its document as failed and raises; rows of an earlier import stay.
    """
    one = store.spark.createDataFrame([(document_id,)], "document_id string")
    try:
        rows = fa.read_rows(store.spark, path, document_id, domain)
        outputs = {"facts": fa.facts(rows), "profiles": ru.facility_profiles(rows), "category_docs": ru.category_docs(rows)}
        # All rows are made before the first table changes.
        made = {table: cut_lineage(found) for table, found in outputs.items()}
    except Exception as error:
        _settle(store, one.select("document_id", F.lit(None).cast("map<string,string>").alias("outputs"), F.lit(str(error)).alias("error")), "parse-facts")
        raise
    for table, found in made.items():
        store.merge(table, found, gone=one)
    _settle(store, one.select("document_id", F.create_map(F.lit("facts_path"), F.lit(path)).alias("outputs"), F.lit(None).cast("string").alias("error")), "parse-facts")
    return ru.rollup_counts(rows, made["profiles"], made["category_docs"])


def parse_pages(store: Store, pages: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Crawled pages (``document_id, domain, page_number, html, url, title`` and ``PAGE_FIELDS``) -> ``structured_html``,
    and the counts of parsed and failed documents.

    A document with a page that can't be parsed is marked as failed and keeps what an earlier run stored of it; all
    others are written.
    """
    if pages.isEmpty():
        raise ValueError("the crawl returned no pages")
    parsed = cut_lineage(ht.parsed_pages(pages))
    domains = pages.groupBy("document_id").agg(F.first("domain").alias("domain"))
    bad = parsed.filter("error IS NOT NULL").groupBy("document_id").agg(F.min(F.struct("page_number", "error")).alias("e"))
    bad = cut_lineage(bad.select("document_id", F.concat(F.lit("page "), F.col("e.page_number").cast("string"), F.lit(": "), F.col("e.error")).alias("error")))
    fine = parsed.join(bad, "document_id", "left_anti")
    nested = ht.all_pages(fine, ht.structured_pages(ht.page_elements(fine))).join(domains, "document_id")
    written = store.merge("structured_html", nested)
    outputs = F.create_map(F.lit("structured_table"), F.lit("structured_html"))
    counts = _settle(store, domains.join(bad, "document_id", "left").select("document_id", outputs.alias("outputs"), "error"), "parse-pages")
    return written, counts


def parse_crawl(store: Store, parsed_dir: str) -> dict[str, int]:
    """Raw crawls ``parsed_dir/<domain>/html/<name>.raw.json`` -> ``structured_html``; counts of both outcomes.

    A crawl with a bad record, or without a page, is marked as failed; its document keeps what was stored of it.
    """
    files = cut_lineage(_named(store, st.read_files(store.spark, f"{parsed_dir}/*/html/*{st.RAW_CRAWL}"), st.RAW_CRAWL, "html"))
    pages, rejected = st.crawl_pages(files)
    known = files.select("path", "document_id", "domain")
    bad = cut_lineage(st.first_errors(rejected.join(known, "path"), "document_id").select("document_id", "error"))
    good = cut_lineage(pages.join(known, "path").join(bad, "document_id", "left_anti").drop("path"))
    counts = {"parsed": 0, "failed": 0}
    if not good.isEmpty():
        counts = parse_pages(store, good)[1]
    outputs = F.lit(None).cast("map<string,string>").alias("outputs")
    failed = _settle(store, bad.select("document_id", outputs, "error"), "parse-crawl")
    return {name: counts[name] + failed[name] for name in counts}


def _named(store: Store, files: DataFrame, suffix: str, source_type: str) -> DataFrame:
    """``files`` with ``document_id`` and ``domain``: documents of the same domain and name that are still to be parsed.
    Without a document table the name is the id."""
    domain, name = st.file_key(F.col("path"), suffix)
    named = files.withColumns({"domain": domain, "_name": name})
    if not store.exists("documents"):
        return named.withColumnRenamed("_name", "document_id")
    pending = ca.pending_documents(store.read("documents"), source_type)
    stems = pending.select("document_id", "domain", F.regexp_replace("file_name", r"\.[^.]*$", "").alias("_name"))
    return named.join(stems, ["domain", "_name"]).drop("_name")


def parse_pdf(store: Store, parsed_dir: str, image_dir: str) -> dict[str, int]:
    """Outputs of the PDF parser -> ``pdf_pages``, ``pdf_content`` and triaged ``pdf_images``; counts of both outcomes.

    ``parsed_dir/<domain>/pdf/<name>.structured.json`` and ``.images.json``; ``image_dir/<domain>/<name>/`` holds the image
    files. A document with a bad record, or without an image list, is marked as failed with the place of the
    first one; it adds nothing and ends no run. Documents parsed before are left alone.
    """
    spark = store.spark
    keyed = lambda rows, suffix: _named(store, rows, suffix, "pdf")
    files = cut_lineage(keyed(st.read_files(spark, f"{parsed_dir}/*/pdf/*{st.STRUCTURED}"), st.STRUCTURED))
    lists = cut_lineage(keyed(st.read_files(spark, f"{parsed_dir}/*/pdf/*{st.IMAGES}"), st.IMAGES))
    pages, bad_pages = st.pdf_pages(files)
    listed, bad_images = st.pdf_images(lists)
    of = lambda rows, known: rows.join(known.select("path", "document_id", "domain"), "path")
    rejected = of(bad_pages, files).unionByName(of(bad_images, lists))
    # A parse without its image list isn't whole.
    missing = files.join(lists, "document_id", "left_anti").select("document_id", F.lit("image list is missing").alias("missing"))
    errors = st.first_errors(rejected, "document_id").select("document_id", "error")
    outputs = files.groupBy("document_id").agg(F.create_map(F.lit("structured_json_path"), F.min("path")).alias("outputs"))
    outcomes = outputs.join(errors, "document_id", "left").join(missing, "document_id", "left")
    outcomes = cut_lineage(outcomes.select("document_id", "outputs", F.coalesce("error", "missing").alias("error")))
    good = outcomes.filter("error IS NULL").select("document_id")

    kept = cut_lineage(of(pages, files).join(good, "document_id", "left_semi"))
    images = of(listed, lists).join(good, "document_id", "left_semi")
    stored = _image_files(store, image_dir)
    _, name = st.file_key(F.col("path"), st.IMAGES)
    images = images.withColumn("folder", name).join(stored, ["domain", "folder", "filename"], "left")
    rows = images.select(
        "document_id", "domain", "idx", "filename", "page", "x", "y", "w", "h", "category", "sha",
        F.lit(None).cast("bigint").alias("phash"), F.col("sha").isNotNull().alias("found"), F.lit(False).alias("photographic"),
    )
    triaged = tr.triage(cut_lineage(rows))
    store.merge("pdf_pages", kept.select("document_id", "domain", "page", "page_number"), gone=good)
    store.merge("pdf_content", nm.page_content(kept), gone=good)
    store.merge("pdf_images", triaged, gone=good)
    return _settle(store, outcomes, "parse-pdf")


def _image_files(store: Store, image_dir: str) -> DataFrame:
    """``(domain, folder, filename, sha)`` of the files in ``image_dir/<domain>/<folder>/``."""
    pattern = f"{image_dir}/*/*/*"
    if not di.files_match(store.spark, pattern):
        return store.spark.createDataFrame([], "domain string, folder string, filename string, sha string")
    files = store.spark.read.format("binaryFile").load(pattern)
    part = lambda n: F.regexp_extract("path", r"([^/]+)/([^/]+)/([^/]+)$", n)
    return files.select(part(1).alias("domain"), part(2).alias("folder"), part(3).alias("filename"), F.sha2("content", 256).alias("sha"))


def _image_leads(store: Store, content: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept images on their pages, the first image of every group with its surroundings)."""
    kept = store.read("pdf_images").filter("reason IS NULL")
    placed = cut_lineage(nm.on_pages(kept.drop("domain"), store.read("pdf_pages")))
    lead = placed.groupBy("document_id", "group_id").agg(F.min("idx").alias("idx"))
    context = nm.image_context(content, placed.join(lead, ["document_id", "group_id", "idx"], "left_semi"))
    return placed, context.withColumn("path_ok", F.lit(True))


def caption(store: Store, model_name: str, make_client: cp.ClientMaker, batch_rows: int = 1000, tries: int = cp.TRIES, pause: float = 1.0) -> dict[str, int]:
    """Captions of all kept images -> ``captions``; counts of what was made and what failed.

    A content is asked for once per model, whatever its number of images. Contents are dealt in batches by their hash,
    and each batch is stored before the next one starts, so a run that died has lost one batch at most. Failed
    contents aren't stored: the next run asks for them again.
    """
    _, leads = _image_leads(store, store.read("pdf_content"))
    prompts = leads.filter("sha IS NOT NULL").groupBy("sha").agg(F.min(tx.caption_prompt(nm.context_fields())).alias("prompt"))
    if store.exists("captions"):
        known = store.read("captions").filter(F.col("model") == model_name)
        prompts = prompts.join(known.select("sha"), "sha", "left_anti")
    prompts = cut_lineage(prompts)
    number = 1 + prompts.count() // batch_rows
    counts = {"generated": 0, "generation_failed": 0}
    for batch in range(number):
        asked = prompts.filter(F.pmod(F.xxhash64("sha"), F.lit(number)) == batch)
        seen = Observation(f"caption-{batch}")
        made = cp.made_captions(asked, make_client, tries, pause).observe(
            seen, F.count_if(F.col("text").isNotNull()).alias("generated"), F.count_if(F.col("text").isNull()).alias("generation_failed")
        )
        made = cut_lineage(made)
        rows = made.filter("text IS NOT NULL").select(F.lit(model_name).alias("model"), "sha", "text")
        store.merge("captions", rows.withColumn("caption_id", F.concat_ws(":", "model", "sha")), "caption_id")
        counts = {name: counts[name] + seen.get[name] for name in counts}
    return counts


def captioned_images(store: Store, content: DataFrame, model_name: str = "none") -> DataFrame:
    """Kept images of ``pdf_images`` on their pages, with the caption of their group as ``text``: what ``caption`` has stored
    for the content of the group's first image, else the surroundings of that image."""
    placed, leads = _image_leads(store, content)
    cache = store.read("captions") if store.exists("captions") else store.spark.createDataFrame([], "model string, sha string, text string")
    told = cp.caption_images(leads, cache, model_name, nm.context_fields())
    captions = told.groupBy("document_id", "group_id").agg(F.min(F.struct("idx", "caption")).alias("c"))
    spots = nm.image_context(content, placed).select(*placed.columns, "below")
    named = spots.join(captions.select("document_id", "group_id", F.col("c.caption").alias("caption")), ["document_id", "group_id"], "left")
    return named.withColumn("text", F.coalesce("caption", F.lit(tx.NO_CAPTION))).drop("caption")


def normalize(store: Store, caption_model: str = "none") -> DataFrame:
    """Parsed tables -> ``elements``; images have the stored captions of ``caption_model``."""
    streams = []
    if store.exists("structured_html"):
        streams.append(nm.normalize_html(store.read("structured_html")))
    if store.exists("pdf_content"):
        content = store.read("pdf_content")
        streams.append(nm.normalize_pdf(content, captioned_images(store, content, caption_model)))
    records = []
    for table, key in (("category_docs", "category_doc_id"), ("profiles", "profile_id")):
        if store.exists(table):
            rows = store.read(table)
            order = F.col("source_row_numbers")[0] if table == "category_docs" else F.col("metadata.source_row_numbers")[0]
            # Profiles and category documents are two files of one source; rows go by first fact row.
            records.append(rows.select("document_id", F.col("metadata.domain").alias("domain"), F.lit(table).alias("file_name"), order.alias("line"), "retrieval_text"))
    if records:
        streams.append(nm.normalize_records(records[0] if len(records) == 1 else records[0].unionByName(records[1])))
    if not streams:
        raise ValueError("nothing is parsed yet")
    merged = streams[0]
    for other in streams[1:]:
        merged = merged.unionByName(other)
    merged = nm.check_values(nm.check_values(merged, "domain", nm.DOMAINS), "source_type", nm.SOURCE_TYPES)
    return store.replace("elements", merged)


def chunk(store: Store, params: ch.ChunkParams = ch.ChunkParams()) -> DataFrame:
    """``elements`` of pdf and html documents -> ``parent_sections`` and ``child_chunks``; documents become chunked."""
    documents = store.read("documents")
    names = ca.chunkable_documents(documents).select("document_id", "file_name")
    elements = store.read("elements").join(names, "document_id")
    heads = ch.headings(elements, params)
    assigned = store.replace("assigned_elements", ch.assign_parents(elements, params))
    store.replace("parent_sections", ch.parent_sections(assigned, heads))
    children = store.replace("child_chunks", ch.child_chunks(assigned, heads, params))
    done = cut_lineage(assigned.select("document_id").distinct()).withColumn("status", F.lit("chunked"))
    store.merge("documents", ca.set_status(documents.join(done, "document_id", "left_semi"), done))
    return children


def retrieval_units(store: Store) -> DataFrame:
    """Children, profiles and category documents under one schema."""
    parts = []
    if store.exists("child_chunks"):
        parts.append(
            store.read("child_chunks").select(
                F.col("chunk_id").alias("unit_id"), "document_id", F.lit("child_chunks").alias("source_table"), "parent_id", "domain",
                F.col("text_content").alias("text"), "file_name",
            )
        )
    for table, key in (("profiles", "profile_id"), ("category_docs", "category_doc_id")):
        if store.exists(table):
            parts.append(
                store.read(table).select(
                    F.col(key).alias("unit_id"), "document_id", F.lit(table).alias("source_table"), F.lit(None).cast("string").alias("parent_id"),
                    F.col("metadata.domain").alias("domain"), F.col("retrieval_text").alias("text"), F.col("metadata.file_name").alias("file_name"),
                )
            )
    if not parts:
        raise ValueError("there are no chunks, profiles or category documents yet")
    merged = parts[0]
    for other in parts[1:]:
        merged = merged.unionByName(other)
    return merged


def index(store: Store, embed) -> DataFrame:
    """Embeddings of the current units: those of unchanged texts stay, changed and new texts get new ones, and those of
    units that are gone go. ``embed`` maps a text column to a vector column."""
    units = retrieval_units(store)
    if not store.exists("embeddings"):
        return store.merge("embeddings", _embedded(units.filter("length(trim(text)) > 0"), embed), "unit_id", partition_by=("domain",))
    stored = store.read("embeddings")
    kept = em.still_valid(stored, units)
    made = _embedded(em.unembedded(units, kept), embed)
    gone = stored.select("unit_id").join(kept.select("unit_id"), "unit_id", "left_anti")
    return store.merge("embeddings", made, "unit_id", gone, ("domain",))


def _embedded(units: DataFrame, embed) -> DataFrame:
    made = em.embed_sparse(units.select("unit_id", "domain", "text").withColumn("vector", embed(F.col("text"))))
    return made.withColumn("text_hash", em.text_hash()).select("unit_id", "domain", "vector", "terms", "weights", "text_hash")


def centroids(store: Store) -> DataFrame:
    return store.replace("domain_centroids", domain_centroids(store.read("embeddings")))


def searchable_units(store: Store) -> DataFrame:
    """Units with their embeddings, as the hybrid search reads them."""
    return retrieval_units(store).drop("domain").join(store.read("embeddings").drop("text_hash"), "unit_id")
