"""The registered queries of the text operators and, where SQL can express one, its DuckDB twin.

Each query applies its operator to the whole table and derives the columns it returns from the
operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.llm import (blocklist, chat, embedding_links, language_svm, merkle_manifest, mixing, packing, page_text,
                            pattern_search, quality_ratio, records, simhash_tree, target_resampling)
from retailcast.llm.common import UPPER, WORD, shared_path, written
from retailcast.llm.words import WORD_CHARS

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]
# name parts of hosts whose pages make up the list of unwanted URLs
LISTED_HOSTS = "ads-track|adult|casino|cheap-pills|free-bets|spam"
# weight of a document in the mix: labelled good, labelled poor, not labelled
GOOD, POOR, UNKNOWN = 2.0, 0.5, 1.0
MIX_SEED = 11
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def mix_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = F.when(F.col("quality") == 1, GOOD).when(F.col("quality") == 0, POOR).otherwise(UNKNOWN)
    return table(spark, sf_dir, "labels").select("doc_id", weight.alias("weight"))


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "records")
    records.write_records(table(spark, sf_dir, "documents"), path, special=True)
    return records.read_records(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.link_embeddings(table(spark, sf_dir, "embeddings"))


def op3_simhash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tree.simhash_components(table(spark, sf_dir, "documents"))


def op4_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ratio.quality_verdicts(table(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))


def op5_language_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_svm.fit_languages(docs.where(~language_svm.held_out()))
    return (language_svm.predict_languages(docs, model)
            .select("doc_id", language_svm.held_out().alias("held_out"), "lang_pred", "score"))


def op6_url_blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(blocklist.host_of(F.col("url")).rlike(LISTED_HOSTS))
    return blocklist.judge_urls(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), quality=mix_weights(spark, sf_dir), seed=MIX_SEED)
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op8_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), special=True)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.main_text(table(spark, sf_dir, "pages"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
                                "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(*own.columns).union(own)
    return chat.conversation_digests(written(chat.format_conversations(turns), "chat"))


def op11_pattern_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pattern_search.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = pattern_search.hit_words()
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = target_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    shown = merkle_manifest.leaf_digest([text if f == "text" else F.col(f) for f in merkle_manifest.FIELDS])
    rows = merkle_manifest.merkle_manifest(docs, carry={"shown": shown})
    rows = rows.withColumn("folded_root", merkle_manifest.fold_path("shown", "path"))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle_manifest.proof_digest("path").alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_token_records, op2_embedding_links, op3_simhash_tree, op4_quality_ratio, op5_language_svm, op6_url_blocklist,
    op7_source_mix, op8_sequence_packing, op9_page_text, op10_chat_format, op11_pattern_search, op12_target_resampling,
    op13_merkle_manifest, pipeline)}

_SOUND = ("label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL "
          "OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0")
OP2_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND {_SOUND}),
n AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
          WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(x, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.x),
least AS (SELECT x, min(root) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, l.component_id, coalesce(e.vec_id = l.component_id, false) AS kept
FROM embeddings e LEFT JOIN least l ON l.x = e.vec_id LEFT JOIN degree d ON d.x = e.vec_id
"""

_FITS = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{{v}}}'".replace("{" + v + "}", f"{v} {h}{p}")
    for v, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2])))
OP6_SQL = f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
keys AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') ||
         regexp_replace(regexp_replace(path, '/+$', ''), '\\.html?$', '') END AS key, CASE {_FITS} END AS fit FROM parts),
listed AS (SELECT DISTINCT key FROM keys WHERE key IS NOT NULL AND regexp_matches(host, '{LISTED_HOSTS}'))
SELECT page_id, host, path, split_part(fit, ' ', 2) AS rule,
       coalesce(split_part(fit, ' ', 1), CASE WHEN key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM keys
"""

_W = {i: w for i, w in enumerate(mixing.WEIGHTS)}
OP7_SQL = f"""
WITH weights AS (SELECT doc_id, max(CASE quality WHEN 1 THEN {GOOD} WHEN 0 THEN {POOR} ELSE {UNKNOWN} END) AS w
                 FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
docs AS (
  SELECT d.doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         -ln((('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null') || ':{MIX_SEED}'), 1, 12))::BIGINT + 0.5) / {float(1 << 48)!r}::DOUBLE)
         / coalesce(w, 1) AS draw
  FROM documents d LEFT JOIN weights USING (doc_id)),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(_W)}
            {" ".join(f"WHEN {i} THEN {w}::DOUBLE" for i, w in _W.items())} END AS weight,
         {mixing.MOST_EPOCHS} * source_size::DOUBLE AS cap FROM sizes),
shares AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM weighed),
targets AS (SELECT source, source_size, least(cap, max(share) OVER () * weight) AS target FROM shares),
run AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS before FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (size * least(whole + CASE WHEN before + size / 2.0::DOUBLE <= target - whole * source_size THEN 1 ELSE 0 END,
                     {mixing.MOST_EPOCHS}))::BIGINT AS taken FROM run
"""

_TEMPLATE = chat.Template()
_ESCAPED = "len(text) + (len(text) - len(replace(text, '\\', '')))" + "".join(
    f" + (len(text) - len(replace(text, '{c}', ''))) // {len(c)}" for c in _TEMPLATE.controls)
_MARKS = " ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b, _) in _TEMPLATE.turns.items())
_MOVES = " OR ".join(f"(before = '{s}' AND role IN ({', '.join(repr(r) for r in rs)}))" for s, rs in _TEMPLATE.moves.items())
OP10_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
steps AS (
  SELECT *, coalesce(lag(role) OVER w, '') AS before, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS total
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
own AS (
  SELECT *, {_ESCAPED} + CASE role {_MARKS} ELSE {len("".join(_TEMPLATE.other).replace("{role}", ""))} + len(role) END AS chars,
         ({_MOVES}) AND (n < total OR role IN ({', '.join(repr(r) for r in _TEMPLATE.ends)})) AS fine FROM steps)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY n)) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars, bool_and(fine) AS valid
FROM own GROUP BY conv_id
"""

_WINDOW = pattern_search.WINDOW
_TEXT_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD_CHARS}')"
OP11_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_TEXT_WORDS} AS w FROM documents),
items AS (SELECT item_id, w, least(len(w), {_WINDOW}) AS n FROM (SELECT item_id, {_TEXT_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
starts AS (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items),
wins AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM starts),
lens AS (SELECT DISTINCT n FROM wins),
words AS (SELECT r, len(w) AS total, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM texts),
ahead AS (SELECT r, p, total, [word, {", ".join(f"lead(word, {k}) OVER s" for k in range(1, _WINDOW))}] AS ws
          FROM words WINDOW s AS (PARTITION BY r ORDER BY p)),
here AS (SELECT r, p, n, array_to_string(ws[1:n], ' ') AS win FROM ahead JOIN lens ON p + n - 1 <= total),
hits AS (SELECT r, p, n, item_id FROM here JOIN wins USING (n, win)),
covered AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT r, p, n FROM hits)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS name FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


def _crc32_sql(value: str) -> str:
    """CRC-32 of a VARCHAR in DuckDB, bit by bit over its UTF-8 bytes."""
    bits = (f"flatten([[(('0x' || hex(encode({value}))[2 * i - 1:2 * i])::BIGINT >> b) & 1 FOR b IN range(8)] "
            f"FOR i IN range(1, strlen({value}) + 1)])")
    step = f"xor(c >> 1, CASE WHEN (c & 1) = bit THEN 0 ELSE {0xEDB88320} END)"
    return f"xor(list_reduce(list_prepend({0xFFFFFFFF}::BIGINT, {bits}), lambda c, bit: {step}), {0xFFFFFFFF})"


_B = target_resampling.BUCKETS
OP12_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TEXT_WORDS} AS w FROM documents),
words AS (SELECT r, unnest(w) AS word FROM docs),
goal AS (SELECT unnest({_TEXT_WORDS}) AS word FROM benchmark),
buckets AS (SELECT word, {_crc32_sql("word")} % {_B} AS bucket FROM (SELECT word FROM words UNION SELECT word FROM goal)),
raw AS (SELECT bucket, count(*) AS s FROM words JOIN buckets USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM goal JOIN buckets USING (word) GROUP BY bucket),
whole AS (SELECT (SELECT count(*) FROM words) AS s_all, (SELECT count(*) FROM goal) AS t_all),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + {_B})::DOUBLE
                / ((s + 1)::DOUBLE * (t_all + {_B})::DOUBLE)))::BIGINT AS gain FROM raw LEFT JOIN target USING (bucket), whole),
sums AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS total FROM words JOIN buckets USING (word) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
         ('0x' || sha256('{target_resampling.SEED}:' || coalesce(doc_id::VARCHAR, 'null'))[1:8])::BIGINT AS h
  FROM docs LEFT JOIN sums USING (r)),
final AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score,
          n_features < {target_resampling.MIN_WORDS} AS short FROM scored),
placed AS (SELECT *, row_number() OVER (ORDER BY short, score DESC, doc_id NULLS FIRST, n_features) AS place FROM final)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= {target_resampling.PERCENT} * (SELECT count(*) FROM final WHERE NOT short) // 100 THEN place END AS rank
FROM placed
"""


def _digest_sql(fields: dict[str, str]) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(({v})::VARCHAR)::VARCHAR || ':' || ({v})::VARCHAR, '-')" for v in fields.values()) + ")"


_K = merkle_manifest.ARITY
_FIELDS = {f: f for f in merkle_manifest.FIELDS}
_TAMPERED = f"CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"


def _trees_sql(name: str, nodes: str) -> str:
    """Levels of trees (tree, level, digests) as a recursive table, from ``nodes`` (tree, digests)."""
    return f"""{name}(tree, level, hs) AS (
  SELECT tree, 0, hs FROM ({nodes}) UNION ALL
  SELECT tree, level + 1, [sha256(array_to_string(hs[{_K} * i + 1:{_K} * i + {_K}], '')) FOR i IN range((len(hs) + {_K - 1}) // {_K})]
  FROM {name} WHERE len(hs) > 1)"""


_SIBLINGS = (f"array_to_string(hs[j - j % {_K} + 1:j], '') AS lefts, "
             f"array_to_string(hs[j + 2:j - j % {_K} + {_K}], '') AS rights")
OP13_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM (
    SELECT row_number() OVER () AS r, doc_id, source, {_digest_sql(_FIELDS)} AS leaf,
           {_digest_sql(_FIELDS | {"text": _TAMPERED})} AS shown FROM documents)),
groups AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, list(leaf ORDER BY place) AS hs FROM leaves GROUP BY source),
{_trees_sql("low", "SELECT tree, hs FROM groups")},
subroots AS (SELECT tree, hs[1] AS subroot FROM low WHERE len(hs) = 1),
{_trees_sql("high", "SELECT 0 AS tree, list(subroot ORDER BY tree) AS hs FROM subroots")},
rows_ AS (SELECT l.*, g.tree FROM leaves l JOIN groups g ON l.source IS NOT DISTINCT FROM g.source),
steps AS (
  SELECT r, level, {_SIBLINGS} FROM (SELECT r, level, hs, place // (pow({_K}, level))::BIGINT AS j FROM rows_ JOIN low USING (tree) WHERE len(hs) > 1)
  UNION ALL
  SELECT r, 1000 + level, {_SIBLINGS} FROM (SELECT r, level, hs, rows_.tree // (pow({_K}, level))::BIGINT AS j FROM rows_, high WHERE len(hs) > 1)),
paths AS (SELECT r, list(lefts ORDER BY level) AS lefts, list(rights ORDER BY level) AS rights,
          string_agg(lefts || rights, '' ORDER BY level) AS proof FROM steps GROUP BY r),
folds(r, i, h) AS (
  SELECT r, 0, shown FROM rows_ UNION ALL
  SELECT f.r, i + 1, sha256(lefts[i + 1] || h || rights[i + 1]) FROM folds f JOIN paths p ON f.r = p.r WHERE i < len(lefts)),
ends AS (SELECT r, arg_max(h, i) AS folded_root FROM folds GROUP BY r),
root AS (SELECT hs[1] AS root FROM high WHERE len(hs) = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM rows_ JOIN subroots USING (tree) JOIN ends USING (r) LEFT JOIN paths USING (r), root
"""
ORACLE_SQL = {"op2_embedding_links": OP2_SQL, "op6_url_blocklist": OP6_SQL, "op7_source_mix": OP7_SQL, "op10_chat_format": OP10_SQL,
              "op11_pattern_search": OP11_SQL, "op12_target_resampling": OP12_SQL, "op13_merkle_manifest": OP13_SQL}
