"""Queries of the operators over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from gaugeflow.llm import decontamination, fill_middle, hard_negatives, lm_scoring
from gaugeflow.llm.decontamination import op4_decontamination
from gaugeflow.llm.fill_middle import op13_fill_middle
from gaugeflow.llm.hard_negatives import op12_hard_negatives
from gaugeflow.llm.line_dedup import op2_line_dedup
from gaugeflow.llm.lm_scoring import op1_lm_scoring
from gaugeflow.llm.near_dedup import op5_near_dedup
from gaugeflow.llm.neighbours import op8_neighbours
from gaugeflow.llm.personal_data import op7_personal_data
from gaugeflow.llm.pieces import op6_pieces
from gaugeflow.llm.quality_rules import op11_quality_rules
from gaugeflow.llm.secret_scan import op3_secret_scan
from gaugeflow.llm.substring_dedup import op9_substring_dedup
from gaugeflow.llm.toxicity import op10_toxicity

QUERIES = {q.__name__: q for q in (
    op1_lm_scoring, op2_line_dedup, op3_secret_scan, op4_decontamination, op5_near_dedup, op6_pieces, op7_personal_data,
    op8_neighbours, op9_substring_dedup, op10_toxicity, op11_quality_rules, op12_hard_negatives, op13_fill_middle)}

# Removal of runs that occur earlier, on plain lines: pairs of lines, their first place, what they cover.
LINE_RUNS = """
with docs as (select doc_id, case when coalesce(text, '') = '' then [] else string_split(text, chr(10)) end ls from documents),
pairs as (select doc_id, p, ls[p:p + 1] run from (select doc_id, ls, unnest(range(1, len(ls))) p from docs)),
firsts as (select run, min({'d': doc_id, 'p': p}) f from pairs group by run),
gone as (select distinct doc_id, unnest([p, p + 1]) p from pairs join firsts using (run) where {'d': doc_id, 'p': p} > f),
islands as (select doc_id, count(*) n from (select doc_id, p - row_number() over (partition by doc_id order by p) g from gone) group by doc_id, g),
counts as (select doc_id, sum(n) n, max(n) longest from islands group by doc_id),
lines as (select doc_id, unnest(ls) l, generate_subscripts(ls, 1) p from docs),
kept as (select doc_id, string_agg(l, chr(10) order by p) t from lines anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(ls) n_lines, cast(coalesce(n, 0) as bigint) n_removed, coalesce(longest, 0) longest, sha256(coalesce(t, '')) kept_sha256
from docs left join counts using (doc_id) left join kept using (doc_id)
"""

WORD_RUNS = r"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents),
windows as (select doc_id, p, array_to_string(ws[p:p + 19], ' ') win from (select doc_id, ws, unnest(range(1, len(ws) - 18)) p from docs)),
firsts as (select win, min({'d': doc_id, 'p': p}) f from windows group by win),
gone as (select distinct doc_id, unnest(range(p, p + 20)) p from windows join firsts using (win) where {'d': doc_id, 'p': p} > f),
counts as (select doc_id, count(*) n from gone group by doc_id),
words as (select doc_id, unnest(ws) w, generate_subscripts(ws, 1) p from docs),
kept as (select doc_id, string_agg(w, ' ' order by p) t from words anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(ws) n_words, coalesce(n, 0) n_removed, sha256(coalesce(t, '')) kept_sha256
from docs left join counts using (doc_id) left join kept using (doc_id)
"""

ORACLES = {
    "op1_lm_scoring": lm_scoring.ORACLE,
    "op2_line_dedup": LINE_RUNS,
    "op4_decontamination": decontamination.ORACLE,
    "op9_substring_dedup": WORD_RUNS,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_fill_middle": fill_middle.ORACLE,
}
