"""The numbered queries and the SQL of those that SQL can express."""

from __future__ import annotations

import string

from .bpe import op6_byte_bpe
from .divergence import ORACLE_SQL as _DIVERGENCE
from .divergence import op13_source_divergence
from .fill_middle import ORACLE_SQL as _FILL_MIDDLE
from .fill_middle import op12_fill_middle
from .html_crf import op9_html_crf
from .jaccard_join import op10_jaccard_join
from .langid import op1_kneser_ney
from .lm import op2_gru_lm
from .mixing import op5_pivotal_mix
from .order_minhash import op8_order_minhash
from .passage_quality import op11_attention_mil
from .passages import op4_repeated_passages
from .repetition import op7_suffix_repetition
from .toxicity import op3_ordinal_toxicity

QUERIES = {
    "op1_kneser_ney": op1_kneser_ney,
    "op2_gru_lm": op2_gru_lm,
    "op3_ordinal_toxicity": op3_ordinal_toxicity,
    "op4_repeated_passages": op4_repeated_passages,
    "op5_pivotal_mix": op5_pivotal_mix,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_suffix_repetition": op7_suffix_repetition,
    "op8_order_minhash": op8_order_minhash,
    "op9_html_crf": op9_html_crf,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_attention_mil": op11_attention_mil,
    "op12_fill_middle": op12_fill_middle,
    "op13_source_divergence": op13_source_divergence,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

#: The others have columns that SQL can't express (model scores, draws, fingerprints, token ids); their tests compare with brute force.
ORACLES: dict[str, str] = {
    "op4_repeated_passages": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
twice AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS j FROM (SELECT doc_id, i FROM win SEMI JOIN twice USING (s)), (SELECT unnest(range(35)) AS k)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t, count(*) AS n FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d) ANTI JOIN gone USING (doc_id, j) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
    "op7_suffix_repetition": f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
b AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, s FROM win GROUP BY 1, 2 HAVING count(*) > 1),
covered AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS j FROM (SELECT doc_id, i FROM win SEMI JOIN twice USING (doc_id, s)), (SELECT unnest(range(5)) AS k)) GROUP BY 1),
long AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, md5(array_to_string(w[i:i + m - 1], ' ')) AS s FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT doc_id, w, CAST(floor(greatest(20, 0.1 * len(w))) AS BIGINT) + 1 AS m FROM d) WHERE len(w) >= m)) GROUP BY doc_id, s HAVING count(*) > 1),
r AS (SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, l.doc_id IS NOT NULL AS long FROM b LEFT JOIN covered USING (doc_id) LEFT JOIN long l USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR long) AS kept FROM r""",
    "op10_jaccard_join": f"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", _LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(min(y), doc_id)) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.x = doc_id GROUP BY doc_id""",
    "op12_fill_middle": _FILL_MIDDLE,
    "op13_source_divergence": _DIVERGENCE,
}
