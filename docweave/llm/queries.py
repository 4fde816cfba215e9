"""The registered queries of the operators: production parameters over whole tables, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def vocabulary(name: str) -> str:
    """A public vocabulary file; it is read here and travels to the tasks with their code."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.quality import quality_verdicts

    judged = quality_verdicts(documents(spark, folder))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_template_leaks(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.template_leaks import leaks

    return leaks(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.line_dedup import repeated_lines

    return repeated_lines(documents(spark, folder))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.secret_scan import scan_secrets

    found = scan_secrets(documents(spark, folder).select("doc_id", "text"))
    digest = F.sha2("base_spans", 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans", "truncated")


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.word_repeats import remove_repeats

    kept = remove_repeats(documents(spark, folder))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.simhash import as_hex, near_duplicates

    return near_duplicates(documents(spark, folder)).select("doc_id", as_hex().alias("fingerprint"), "component_id")


def op7_token_count(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.token_count import count_tokens

    counted = count_tokens(documents(spark, folder).select("doc_id", "text"), vocabulary("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op8_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.chunk_bpe import encode_texts

    decoded = encode_texts(documents(spark, folder).select("doc_id", "text"), vocabulary("byte_bpe_50k.json"), decode=True)
    digests = (F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
    return decoded.select("doc_id", "n_tokens", *digests)


def op9_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.byte_repeats import remove_repeats

    kept = remove_repeats(documents(spark, folder), keep_first=False)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.language import held_out, identify, learn

    docs = documents(spark, folder)
    model = learn(docs.filter(~held_out("doc_id") & F.col("doc_id").isNotNull()))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.filter_audit import audit_filters

    return audit_filters(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op12_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.packing import pack_documents

    return pack_documents(documents(spark, folder), vocabulary("word_bpe_49k.json"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    from docweave.llm.collocations import collocations

    return collocations(documents(spark, folder))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_template_leaks": op2_template_leaks,
    "op3_line_dedup": op3_line_dedup,
    "op4_secret_scan": op4_secret_scan,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_simhash": op6_simhash,
    "op7_token_count": op7_token_count,
    "op8_bpe_codec": op8_bpe_codec,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_language_id": op10_language_id,
    "op11_filter_audit": op11_filter_audit,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_collocations": op13_collocations,
}

_WORDS = r"'[^\x20\x09-\x0D]+'"

_METRICS = """SELECT r, lang, source, 'word_length' AS metric, 100 * word_chars // n_words AS v, 100 AS spread FROM c WHERE n_words > 0
  UNION ALL SELECT r, lang, source, 'symbol_share', 10000 * n_symbols // word_chars, 400 FROM c WHERE word_chars > 0
  UNION ALL SELECT r, lang, source, 'dup_line_share', 10000 * n_dup_lines // n_lines, 1500 FROM c WHERE n_lines > 0
  UNION ALL SELECT r, lang, source, 'repeat_share', 10000 * n_repeat_words // n_words, 1000 FROM c WHERE n_words > 0"""


def _sql_quartiles(name: str, keys: str) -> str:
    """Quartiles of the sketches summed over ``keys``."""
    return f"""{name} AS (SELECT {keys}metric, any_value(total) AS n, min(CASE WHEN upto * 4 >= total THEN b END) AS q1,
    min(CASE WHEN upto * 4 >= total * 3 THEN b END) AS q3
  FROM (SELECT {keys}metric, b, sum(n) OVER (PARTITION BY {keys}metric ORDER BY b) AS upto, sum(n) OVER (PARTITION BY {keys}metric) AS total
    FROM (SELECT {keys}metric, b, sum(n) AS n FROM sketch GROUP BY {keys}metric, b)) GROUP BY {keys}metric)"""


ORACLES: dict[str, str] = {
    "op1_quality_rules": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, {_WORDS}) AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {_WORDS})) AS ls FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY r),
c AS (SELECT w.r, doc_id, lang, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
  coalesce(rep.n, 0) AS n_repeat_words FROM w LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
m AS ({_METRICS}),
sketch AS (SELECT lang, source, metric, (v - v % (2 ** greatest(length(bin(v)) - 7, 0))::BIGINT) AS b, count(*) AS n
  FROM m SEMI JOIN (SELECT r FROM f WHERE NOT base_failed) USING (r) GROUP BY ALL),
{_sql_quartiles("own", "lang, source, ")},
{_sql_quartiles("by_lang", "lang, ")},
{_sql_quartiles("everything", "")},
q AS (SELECT o.lang, o.source, o.metric, CASE WHEN o.n >= 200 THEN o.q1 WHEN l.n >= 200 THEN l.q1 ELSE e.q1 END AS q1,
    CASE WHEN o.n >= 200 THEN o.q3 WHEN l.n >= 200 THEN l.q3 ELSE e.q3 END AS q3
  FROM own o JOIN by_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.metric = l.metric JOIN everything e ON o.metric = e.metric),
out AS (SELECT m.r FROM m JOIN q ON m.lang IS NOT DISTINCT FROM q.lang AND m.source IS NOT DISTINCT FROM q.source AND m.metric = q.metric
  WHERE v > q3 + 3 * greatest(q3 - q1, spread) OR m.metric = 'word_length' AND v < q1 - 3 * greatest(q3 - q1, spread))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM out) AS kept FROM f""",
    "op3_line_dedup": f"""
WITH l AS (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) - 1 AS line_no FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
t AS (SELECT doc_id, line_no, list_sort(list_distinct(regexp_extract_all(line, {_WORDS}))) AS s FROM l),
c AS (SELECT s, row_number() OVER () AS id, len(s) AS n, place FROM (SELECT s, min(struct_pack(d := doc_id, l := line_no)) AS place FROM t WHERE len(s) > 0 GROUP BY s)),
x AS (SELECT id, n, place, unnest(s) AS tok FROM c),
f AS (SELECT tok, count(*) AS k FROM x GROUP BY tok),
p AS (SELECT id, n, place, tok FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k, tok) AS i FROM x JOIN f USING (tok)) WHERE i <= n - (4 * n + 4) // 5 + 1),
pairs AS (SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b ON a.tok = b.tok AND a.place > b.place WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
hit AS (SELECT DISTINCT a FROM pairs JOIN c x ON x.id = a JOIN c y ON y.id = b WHERE 9 * len(list_intersect(x.s, y.s)) >= 4 * (x.n + y.n))
SELECT doc_id, line_no::INT AS line_no, struct_pack(d := doc_id, l := line_no) > place AS copy FROM t JOIN c USING (s)
WHERE struct_pack(d := doc_id, l := line_no) > place OR id IN (SELECT a FROM hit)""",
    "op5_substring_dedup": f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w)),
m AS (SELECT doc_id, i FROM (SELECT *, min(struct_pack(d := doc_id, i := i)) OVER (PARTITION BY h) AS lead FROM h) WHERE struct_pack(d := doc_id, i := i) > lead),
g AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM m)),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM w),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n FROM x ANTI JOIN g USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)""",
    "op11_filter_audit": f"""
WITH l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
w AS (SELECT *, regexp_extract_all(text, {_WORDS}) AS w FROM d),
m AS (SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask FROM w),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit,
    coalesce(list_sum([1 << (ascii(x) - 65) FOR x IN string_split(filter_order[1:step - 1], '') IF x <> '']), 0)::INT AS before FROM o, range(1, 6) r(step)),
r AS (SELECT part, filter_order, step::INT AS step, bit, sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM c, s GROUP BY ALL)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r""",
    "op13_collocations": """
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) r(k))),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
i AS (SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS within
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL),
x AS (SELECT c.lang, c.phrase, c.a, unnest(range(1, c.k)) AS cut, c.k, c.w FROM c LEFT JOIN i USING (lang, phrase) WHERE within IS NULL OR 100 * within < 100 * a),
y AS (SELECT x.lang, x.phrase, x.a, cut, h.a AS l, e.a AS r, n, (1000::HUGEINT * x.a * n // (h.a::HUGEINT * e.a))::BIGINT AS score FROM x
  JOIN f h ON h.lang = x.lang AND h.phrase = array_to_string(w[1:cut], ' ') JOIN f e ON e.lang = x.lang AND e.phrase = array_to_string(w[cut + 1:x.k], ' ')
  JOIN t ON t.lang = x.lang),
b AS (SELECT lang, phrase, a, arg_min(struct_pack(l := l, r := r, n := n, score := score), struct_pack(s := score, c := cut)) AS b FROM y GROUP BY ALL)
SELECT lang, rank, phrase, a, b.l AS l, b.r AS r, b.n AS n, b.score AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY b.score DESC, a DESC, phrase) AS rank FROM b) WHERE rank <= 2000""",
}
