"""Check SQL (DuckDB) of importance resampling, top-k search and the manifest."""

from __future__ import annotations

_CRC_TABLE = """(SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT) ORDER BY i)
         FROM (SELECT unnest(range(0, 256)) AS i))"""


def crc32_sql(text: str, table: str) -> str:
    """CRC-32 of a text's UTF-8 bytes; ``table`` names the column with the list of the 256 remainders."""
    digits = f"hex(encode({text}))"
    byte = f"('0x' || substr({digits}, 2 * j::INT + 1, 2))::BIGINT"
    return (f"xor(4294967295, list_reduce(range(0, strlen({text})), lambda c, j: xor({table}[(xor(c, {byte}) & 255) + 1], c >> 8), "
            "4294967295::BIGINT))")


def merkle_sql(levels: int = 5, top_levels: int = 3, fanout: int = 16) -> str:
    """Trees of up to fanout ** levels leaves a source and fanout ** top_levels sources."""
    def record(text: str) -> str:
        fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}) || ':' || {f} END" for f in fields)

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def tree(prefix: str, first: str, height: int) -> list[str]:
        """Levels prefix0.. of (tree, i, h, n): runs become their digests while a tree has several nodes."""
        parts = [f"{prefix}0 AS ({first})"]
        for x in range(height):
            parts.append(f"""{prefix}{x + 1} AS (
  SELECT tree, i // {fanout} AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, (any_value(n) + {fanout - 1}) // {fanout} AS n
  FROM {prefix}{x} WHERE n > 1 GROUP BY tree, i // {fanout}
  UNION ALL SELECT tree, i, h, n FROM {prefix}{x} WHERE n = 1)""")
            parts.append(f"""{prefix}r{x} AS (
  SELECT tree, i // {fanout} AS run, list(h ORDER BY i) AS hs FROM {prefix}{x} WHERE n > 1 GROUP BY tree, i // {fanout})""")
        return parts

    def climb(name: str, source: str, prefix: str, height: int) -> list[str]:
        """From rows with tree, i, n, folded and sibs to the tree's root: fold the digest, collect the siblings."""
        parts, last = [], source
        for x in range(height):
            place = f"(i % {fanout})"
            others = f"array_to_string(list_filter(hs, lambda h, k: k - 1 <> {place}), '')"
            whole = f"array_to_string(list_transform(hs, lambda h, k: CASE WHEN k - 1 = {place} THEN folded ELSE h END), '')"
            parts.append(f"""{name}{x} AS (
  SELECT s.* REPLACE (s.i // {fanout} AS i, CASE WHEN hs IS NULL THEN folded ELSE sha256({whole}) END AS folded,
                      sibs || CASE WHEN hs IS NULL THEN '' ELSE {others} END AS sibs)
  FROM {last} s LEFT JOIN {prefix}r{x} r ON r.tree = s.tree AND r.run = s.i // {fanout})""")
            last = f"{name}{x}"
        return parts

    parts = [
        f"crc AS (SELECT {_CRC_TABLE} AS t)",
        f"""docs AS (
  SELECT doc_id, source, sha256({record('text')}) AS leaf,
         CASE WHEN {crc32_sql("coalesce(doc_id::VARCHAR, '')", 't')} % 5 = 0 THEN sha256({record(lower)}) ELSE sha256({record('text')}) END AS seen
  FROM documents, crc)""",
        """placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM docs)""",
        *tree("l", "SELECT tree, i, leaf AS h, n FROM placed", levels),
        *tree("t", f"SELECT -1 AS tree, tree AS i, h, count(*) OVER () AS n FROM l{levels}", top_levels),
        "start AS (SELECT *, seen AS folded, '' AS sibs FROM placed)",
        *climb("c", "start", "l", levels),
        f"""middle AS (
  SELECT s.* REPLACE (-1 AS tree, s.tree AS i), l.h AS subroot FROM c{levels - 1} s JOIN l{levels} l ON l.tree = s.tree)""",
        *climb("d", "middle", "t", top_levels),
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT d.doc_id, d.leaf, d.subroot, t.h AS root, sha256(d.sibs) AS proof_sha256, d.folded AS folded_root, d.folded = t.h AS verified
FROM d{top_levels - 1} d, t{top_levels} t"""


def importance_sql(buckets: int, percent: int, least_words: int, seed: int) -> str:
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH crc AS (SELECT {_CRC_TABLE} AS t),
d AS (SELECT doc_id, row_number() OVER () AS k, {words} AS ws FROM documents),
b AS (SELECT {words} AS ws FROM benchmark),
dw AS (SELECT k, unnest(ws) AS w FROM d),
bw AS (SELECT unnest(ws) AS w FROM b),
bucket AS (SELECT w, {crc32_sql('w', 't')} % {buckets} AS g FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc),
s AS (SELECT g, count(*) AS n FROM dw JOIN bucket USING (w) GROUP BY g),
t AS (SELECT g, count(*) AS n FROM bw JOIN bucket USING (w) GROUP BY g),
sizes AS (SELECT (SELECT count(*) FROM dw)::DOUBLE AS s_all, (SELECT count(*) FROM bw)::DOUBLE AS t_all),
gain AS (
  SELECT g, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + {buckets}) / ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + {buckets}))))::BIGINT AS gain
  FROM s FULL JOIN t USING (g), sizes),
weighed AS (SELECT k, sum(gain)::BIGINT AS total, count(*)::BIGINT AS n FROM dw JOIN bucket USING (w) JOIN gain USING (g) GROUP BY k),
scored AS (
  SELECT doc_id, k, len(ws)::BIGINT AS n_features, coalesce(CASE WHEN total < 0 THEN -((n - 1 - total) // n) ELSE total // n END, 0)::BIGINT AS weight,
         floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM d LEFT JOIN weighed USING (k)),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY weight + noise DESC, doc_id NULLS LAST) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= {least_words})
SELECT s.doc_id, s.n_features, s.weight, s.weight + s.noise AS score, r.r::BIGINT AS rank
FROM scored s LEFT JOIN (SELECT k, r FROM ranked WHERE r <= {percent} * n // 100) r USING (k)"""


def top_k_sql(k: int, every: int, scale: int) -> str:
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {every} = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= {k}"""
