"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, hnsw, infill, langid, lm, mixing, negatives, packing, pii, quality, sharding, simhash, topk
from .common import stage


def tokenizer_path() -> str:
    """The public tokenizer that the packing query is fixed to."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), distance=4, shingle=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = stage(mixing.plan_mix(_table(spark, sf_dir, "documents"), lambda names: [(3, 1, 2)[i % 3] for i in range(len(names))]).plan)
    found = plan.join(mixing.places(plan), "row", "left")
    listed = lambda name, kind: F.coalesce(F.col("places")[name], F.array().cast(f"array<{kind}>")).alias(f"{name}s")
    return found.select("doc_id", "size", "source_size", "target", "taken", listed("shard", "int"), listed("slot", "long"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(_table(spark, sf_dir, "documents"))


def op8_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


def op9_quotation_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chat.link_quotations(_table(spark, sf_dir, "conversations"))
    return found.withColumnRenamed("conversation_id", "conv_id")


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign_shards(_table(spark, sf_dir, "documents"), 40)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["base"])
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [count(k) for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(pii.as_text(base).cast("binary"), 256).alias("base_sha256"), pii.as_text(F.col("found")).alias("spans"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.transform(_table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    restored = infill.restore(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored).alias("restored_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), lambda v: v.where(F.col("vec_id") % 100 == 0), label=label)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_hnsw_neighbours": op5_hnsw_neighbours,
    "op6_mix_sources": op6_mix_sources,
    "op7_language_id": op7_language_id,
    "op8_recurrent_lm": op8_recurrent_lm,
    "op9_quotation_chat": op9_quotation_chat,
    "op10_byte_shards": op10_byte_shards,
    "op11_personal_data": op11_personal_data,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_hard_negatives": op13_hard_negatives,
}

def _personal_data_sql() -> str:
    """Each kind's spans by splitting whole texts at its pattern, with the same confirmations written out."""
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: (({digits})[-i]::INTEGER * (2 - i % 2)) - CASE WHEN (({digits})[-i]::INTEGER * (2 - i % 2)) > 9 THEN 9 ELSE 0 END)) % 10 = 0"
    number = "list_reduce(list_concat([0::BIGINT], list_transform(string_split(substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4), ''), lambda c: CASE WHEN c >= 'A' THEN ord(c) - 55 ELSE ord(c) - 48 END::BIGINT)), lambda a, c: (a * CASE WHEN c > 9 THEN 100 ELSE 10 END + c) % 97) = 1"
    confirm = [
        "true",
        "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(TRY_CAST(ltrim(p, '0') AS INTEGER), 0) > 255)) = 0",
        f"length({digits}) BETWEEN 16 AND 19 AND {luhn}",
        f"length({digits}) BETWEEN 8 AND 15",
        f"m[1] IN ('3', '4', '5', '6') AND length({digits}) BETWEEN 13 AND 15 AND {luhn}",
        "true",
        number,
        "m[1:3] NOT IN ('000', '666') AND m[1] <> '9' AND m[5:6] <> '00' AND m[8:11] <> '0000'",
    ]
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for i, (kind, check) in enumerate(zip(pii.KINDS, confirm, strict=True)):
        place = pii.ORDER.index(kind.name)
        parts.append(f"""
        p{i} AS (SELECT row, unnest(regexp_extract_all(text, {quoted(kind.pattern)})) AS m, generate_subscripts(regexp_extract_all(text, {quoted(kind.pattern)}), 1) AS i,
                        unnest(regexp_split_to_array(text, {quoted(kind.pattern)})[:-2]) AS gap FROM d WHERE regexp_matches(text, {quoted(kind.pattern)})),
        s{i} AS (SELECT row, {quoted(kind.name)} AS kind, {i} AS n, {place} AS place, {str(kind.base).lower()} AS base, m,
                        (sum(length(gap) + length(m)) OVER (PARTITION BY row ORDER BY i) - length(m))::BIGINT AS a FROM p{i}),
        c{i} AS (SELECT s{i}.*, a + length(m) AS e, text, {kind.prior}
                        + CASE WHEN regexp_matches(substr(text, greatest(1, a - {pii.NEARBY - 1}), least(a, {pii.NEARBY})), {quoted(kind.near)}) OR regexp_matches(substr(text, a + length(m) + 1, {pii.NEARBY}), {quoted(kind.near)}) THEN {pii.FOR} ELSE 0 END
                        - CASE WHEN regexp_matches(substr(text, greatest(1, a - {pii.NEARBY - 1}), least(a, {pii.NEARBY})), {quoted(kind.against)}) OR regexp_matches(substr(text, a + length(m) + 1, {pii.NEARBY}), {quoted(kind.against)}) THEN {pii.AGAINST} ELSE 0 END AS score
                 FROM s{i} JOIN d USING (row) WHERE {check})""")
    every = " UNION ALL ".join(f"SELECT * FROM c{i}" for i in range(len(pii.KINDS)))
    return f"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),{",".join(parts)},
        c AS ({every}),
        f AS (SELECT * FROM c WHERE base OR (score > {pii.THRESHOLD} - 1e-9 AND NOT regexp_matches(substr(text, a, 1) || substr(text, e + 1, 1), '[A-Za-z0-9]')
              AND NOT EXISTS (SELECT 1 FROM c AS o WHERE o.row = c.row AND o.base AND o.a < c.e AND c.a < o.e))),
        g AS (SELECT * FROM f WHERE base OR NOT EXISTS (SELECT 1 FROM f AS o WHERE o.row = f.row AND NOT o.base AND o.n < f.n AND o.a < f.e AND f.a < o.e)),
        j AS (SELECT row, string_agg(kind || ':' || a || ':' || e, ',' ORDER BY place, a, e) AS spans, string_agg(CASE WHEN base THEN kind || ':' || a || ':' || e END, ',' ORDER BY place, a, e) AS own,
                     {", ".join(f"count(*) FILTER (base AND kind = '{k}') AS n_{k}" for k in ("email", "ip", "card", "phone"))} FROM g GROUP BY row)
        SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in ("email", "ip", "card", "phone"))}, sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN j USING (row)"""


ORACLE_SQL: dict[str, str] = {
    "op2_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), r AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op9_quotation_chat": r"""
        WITH RECURSIVE m AS (
            SELECT row_number() OVER () AS row, conv_id, turn, role, list_transform(regexp_split_to_array(coalesce(text, ''), '\r\n|\r|\n'), lambda x: {
                'level': length(regexp_extract(x, '^((?:[ \t]*>)+)', 1)) - length(replace(regexp_extract(x, '^((?:[ \t]*>)+)', 1), '>', '')),
                'content': CASE WHEN regexp_matches(x, '^(?:[ \t]*>)+') THEN trim(regexp_replace(x, '^(?:[ \t]*>)+', '')) ELSE x END}) AS lines
            FROM conversations),
        t AS (
            SELECT row, conv_id, turn, role, regexp_replace(array_to_string(list_transform(list_filter(lines, lambda x, i:
                x.level = 0 AND NOT (regexp_matches(x.content, '(?i)\b(?:wrote|writes|said)\s*:\s*$') AND coalesce(lines[i + 1].level > 0, false))),
                lambda x: x.content), chr(10)), '^\s+|\s+$', '', 'g') AS text FROM m),
        v AS (SELECT row, conv_id, turn, lines, unnest(list_distinct(list_transform(lines, lambda x: x.level))) AS level FROM m),
        w AS (SELECT row, conv_id, turn, level, array_to_string(list_transform(lines, lambda x: CASE WHEN x.level = level THEN x.content ELSE '' END), chr(10)) AS own FROM v),
        p AS (
            SELECT DISTINCT row, conv_id, turn, level, trim(regexp_replace(lower(part), '\s+', ' ', 'g')) AS passage
            FROM (SELECT *, unnest(list_concat([own], list_concat(regexp_split_to_array(own, '\n\s*\n'), string_split(own, chr(10))))) AS part FROM w)),
        o AS (SELECT conv_id, passage, min({'turn': turn, 'row': row}) AS first FROM p WHERE level = 0 AND turn IS NOT NULL AND passage <> '' GROUP BY ALL),
        k AS (
            SELECT p.row, o.first.row AS parent, o.first.turn AS reply_to, row_number() OVER (PARTITION BY p.row ORDER BY level, length(passage) DESC, o.first.turn, o.first.row) AS n
            FROM p JOIN o USING (passage) WHERE level > 0 AND p.conv_id IS NOT DISTINCT FROM o.conv_id AND o.first.turn < p.turn),
        links AS (SELECT row, parent, reply_to FROM k WHERE n = 1),
        up AS (SELECT row, parent AS root FROM links UNION ALL SELECT up.row, links.parent FROM up JOIN links ON up.root = links.row),
        threads AS (SELECT up.row, root, m.turn AS root_turn FROM up JOIN m ON up.root = m.row WHERE root NOT IN (SELECT row FROM links)),
        f AS (SELECT t.*, reply_to, coalesce(root_turn, turn) AS root_turn, coalesce(root, t.row) AS root FROM t LEFT JOIN links USING (row) LEFT JOIN threads USING (row))
        SELECT conv_id, turn, role, text, reply_to, root_turn,
               row_number() OVER (PARTITION BY conv_id ORDER BY root_turn NULLS FIRST, root, turn NULLS FIRST, row) - 1 AS position,
               '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS formatted FROM f""",
    "op10_byte_shards": """
        WITH RECURSIVE bit AS (
            SELECT range AS i, range AS c, 0 AS k FROM range(256)
            UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bit WHERE k < 8),
        tab AS (SELECT list(c ORDER BY i) AS tab FROM bit WHERE k = 8),
        d AS (SELECT doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS h, strlen(coalesce(text, '')) + 16 AS size FROM documents),
        x AS (SELECT DISTINCT h, hex(encode(t)) AS x FROM d),
        y AS (SELECT h, list_transform(range(0, length(x), 2), lambda i: ('0x' || substr(x, i + 1, 2))::BIGINT) AS b FROM x),
        z AS (SELECT h, xor(list_reduce(list_concat([4294967295], b), lambda c, v: xor(tab[(xor(c, v) & 255) + 1], c >> 8)), 4294967295) AS crc FROM y, tab),
        r AS (SELECT *, sum(size) OVER w - size AS start, sum(size) OVER () AS total FROM d WINDOW w AS (ORDER BY h, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)),
        c AS (SELECT *, least(39, (2 * start + size) * 40 // (2 * total))::INTEGER AS shard FROM r)
        SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'bytes' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY start) - 1 AS slot, NULL::INTEGER AS grown_shard FROM c JOIN z USING (h)""",
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
            FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ), n AS (
            SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
                   vec_id AS negative_id, positive_score, score AS negative_score
            FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        )
        SELECT * FROM n WHERE rank <= 10""",
    "op11_personal_data": _personal_data_sql(),
    "op12_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS x,
                   regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM documents),
        h AS (SELECT *, len(units) AS n, list_transform(range(4), lambda i: ('0x' || substr(x, 8 * i + 1, 8))::BIGINT) AS h FROM d),
        c AS (
            SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
                        WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
        p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p""",
}
