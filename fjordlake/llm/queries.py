"""The corpus operators' registered queries and, where SQL can express them, their DuckDB forms."""

from __future__ import annotations

from fjordlake.llm.decontamination import op7_decontamination
from fjordlake.llm.language import op5_language_id
from fjordlake.llm.licenses import op4_license_scans
from fjordlake.llm.near_duplicates import op1_ngram_jaccard_join
from fjordlake.llm.packing import op6_packing
from fjordlake.llm.quality import op2_quality
from fjordlake.llm.secrets import op3_secrets
from fjordlake.llm.spelling import op11_spelling_variants
from fjordlake.llm.token_output import op8_token_output
from fjordlake.llm.top_k import op9_top_k_search
from fjordlake.llm.toxicity import op10_toxicity
from fjordlake.llm.whitening import op13_embedding_whitening
from fjordlake.llm.word_codec import op12_bpe_codec

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_quality": op2_quality,
    "op3_secrets": op3_secrets,
    "op4_license_scans": op4_license_scans,
    "op5_language_id": op5_language_id,
    "op6_packing": op6_packing,
    "op7_decontamination": op7_decontamination,
    "op8_token_output": op8_token_output,
    "op9_top_k_search": op9_top_k_search,
    "op10_toxicity": op10_toxicity,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_bpe_codec": op12_bpe_codec,
    "op13_embedding_whitening": op13_embedding_whitening,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op7_decontamination": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
t AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS t FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0) x),
p AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS t FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM t) z WHERE len(w) >= n) x),
h AS (SELECT p.doc_id, p.i, p.n, t.item_id FROM p JOIN t ON p.n = t.n AND p.t = t.t),
k AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM h) x GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN k USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op9_top_k_search": """WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])), 0) AS BIGINT) AS score FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) r WHERE rank <= 5""",
}
