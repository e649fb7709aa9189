"""SQL for the plans, written for an ANSI engine over the same tables.

Common tables are named once and put in front of a query with what they need.
"""

from __future__ import annotations

from budgetloom.functions import text as rules

_CTES: dict[str, tuple[str, str]] = {
    # name: (needs, sql)
    "scored0": ("", """SELECT doc_id, min(orig_doc_id) AS orig_doc_id, CAST(min(tok) AS BIGINT) AS len, min(fasttext) AS raw, min(fasttext_ranking_v2) AS s1,
        min(fineweb_edu_ranking_v2) AS s2, min(modernbert_ranking_v2) AS s3, min(coalesce(lower(trim(topic)), '(none)')) AS topic FROM pool
        WHERE tok > 0 AND doc_id IS NOT NULL AND fasttext_ranking_v2 IS NOT NULL AND fineweb_edu_ranking_v2 IS NOT NULL AND modernbert_ranking_v2 IS NOT NULL GROUP BY doc_id"""),
    "scored1": ("scored0", "SELECT *, CAST(CAST(s1 + s2 + s3 AS DOUBLE) / 3 AS FLOAT) AS q FROM scored0"),
    "scored2": ("scored1", "SELECT *, CAST(CAST((s1 - q) * (s1 - q) + (s2 - q) * (s2 - q) + (s3 - q) * (s3 - q) AS DOUBLE) / 3 AS FLOAT) AS v FROM scored1"),
    "scored": ("scored2", "SELECT *, CAST(q + CAST(0.5 AS FLOAT) * CAST(sqrt(CAST(v AS DOUBLE)) AS FLOAT) AS FLOAT) AS u, md5('42:tie:' || doc_id) AS tie FROM scored2"),
    "budget": ("scored", "SELECT CAST(sum(len) // 12 AS BIGINT) AS b, count(*) AS n FROM scored"),
    "holdout": ("scored budget", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:val:' || doc_id), doc_id) AS k FROM scored) WHERE k <= (SELECT greatest(1, n // 2000) FROM budget)"),
    "alive": ("scored holdout", "SELECT * FROM scored WHERE doc_id NOT IN (SELECT doc_id FROM holdout)"),
    "by_score": ("alive", """SELECT *, row_number() OVER (ORDER BY s1 DESC, tie, doc_id) AS rn,
        CAST(coalesce(sum(len) OVER (ORDER BY s1 DESC, tie, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_len FROM alive"""),
    "base": ("by_score budget", "SELECT * FROM by_score WHERE rn = 1 OR before_len < (SELECT b FROM budget)"),
    "base_size": ("base", "SELECT CAST(sum(len) AS BIGINT) AS t, count(*) AS n FROM base"),
    "residual": ("alive base", "SELECT * FROM alive WHERE doc_id NOT IN (SELECT doc_id FROM base)"),
    "quality_base": ("by_score base_size budget", "SELECT * FROM by_score WHERE rn > (SELECT n FROM base_size) AND (rn = (SELECT n + 1 FROM base_size) OR before_len - (SELECT t FROM base_size) < (SELECT b FROM budget))"),
    "quality_first": ("by_score base_size budget", "SELECT * FROM by_score WHERE rn > (SELECT n FROM base_size) AND (rn = (SELECT n + 1 FROM base_size) OR before_len - (SELECT t FROM base_size) < (SELECT 2 * b FROM budget))"),
    "topic_quota": ("residual budget", """SELECT topic, count(*) AS docs, CAST(sum(len) AS BIGINT) AS tokens, CAST(2 * (SELECT b FROM budget) AS DOUBLE) * CAST(sum(len) AS DOUBLE) / (SELECT CAST(sum(len) AS DOUBLE) FROM residual) AS quota
        FROM residual GROUP BY topic"""),
    "topic_fill": ("residual topic_quota", """SELECT * FROM (SELECT r.*, quota, row_number() OVER (PARTITION BY r.topic ORDER BY q DESC, tie, doc_id) AS rn,
        CAST(coalesce(sum(len) OVER (PARTITION BY r.topic ORDER BY q DESC, tie, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_len
        FROM residual r JOIN topic_quota t ON r.topic = t.topic) WHERE rn = 1 OR before_len < quota"""),
    "candidates": ("c1 c2 c3 residual", """SELECT r.doc_id, len, q, v, u, tie, r.doc_id IN (SELECT doc_id FROM c1) AS in1, r.doc_id IN (SELECT doc_id FROM c2) AS in2, r.doc_id IN (SELECT doc_id FROM c3) AS in3
        FROM residual r WHERE r.doc_id IN (SELECT doc_id FROM c1 UNION SELECT doc_id FROM c2 UNION SELECT doc_id FROM c3)"""),
    "taus": ("candidates", "SELECT quantile_cont(CAST(q AS DOUBLE), 0.3) AS tau_q, quantile_cont(CAST(v AS DOUBLE), 0.9) AS tau_v FROM candidates"),
    "feasible": ("candidates taus", "SELECT c.* FROM candidates c, taus WHERE q >= CAST(tau_q AS FLOAT) AND v <= CAST(tau_v AS FLOAT)"),
    "passes0": ("", """SELECT rewrite_id, min(doc_id) AS doc_id, min(setting) AS setting, min(pass_name) AS pass_name, min(shard_index) AS shard_index, min(rewritten_tokens) AS rewritten_tokens,
        min(status) AS status, min(wrap_style) AS wrap_style, min(finish_reason) AS finish_reason, min(input_tokens_qwen) AS input_tokens_qwen, min(rewritten) AS rewritten FROM rewritten GROUP BY rewrite_id"""),
    "passes": ("passes0", "SELECT *, CAST(coalesce(rewritten_tokens, 0) + 1 AS BIGINT) AS len, CASE WHEN pass_name = 'p1' THEN 0 ELSE 1 END AS tier FROM passes0"),
    "done": ("passes", "SELECT * FROM passes WHERE status = 2"),
    "keyed": ("done scored", "SELECT d.*, s1, s2, s3, u, topic, s.len AS source_len FROM done d JOIN scored s ON d.doc_id = s.doc_id"),
    "rescored": ("", """SELECT doc_id, pass_name, min(status) AS status, min(rewritten_tokens) AS rewritten_tokens, min(rewritten_fasttext_score) AS score, min(rewritten_fasttext_ranking_v2) AS ranking,
        CAST(coalesce(min(rewritten_tokens), 0) + 1 AS BIGINT) AS len FROM scored_rewrites GROUP BY doc_id, pass_name"""),
    "both_pool": ("rescored", "SELECT * FROM rescored WHERE status = 2 AND score IS NOT NULL"),
    "refilter": ("both_pool", """SELECT * FROM (SELECT *, row_number() OVER (ORDER BY score DESC, pass_name DESC, doc_id) AS rn,
        CAST(coalesce(sum(len) OVER (ORDER BY score DESC, pass_name DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_len FROM both_pool)
        WHERE rn = 1 OR before_len < (SELECT CAST(sum(len) * 3 // 10 AS BIGINT) FROM both_pool)"""),
    "blocks": ("base quality_base quality_first uniform oversample topic_fill disagree", """SELECT 'base' AS block, doc_id, len FROM base UNION ALL SELECT 'quality_base', doc_id, len FROM quality_base UNION ALL SELECT 'quality_prefix', doc_id, len FROM quality_first
        UNION ALL SELECT 'styled_random', doc_id, len FROM uniform UNION ALL SELECT 'oversample_refilter', doc_id, len FROM oversample UNION ALL SELECT 'topic_quota', doc_id, len FROM topic_fill UNION ALL SELECT 'disagreement', doc_id, len FROM disagree"""),
    "pool_texts": ("", "SELECT doc_id, min(text) AS text, CAST(min(coalesce(tokens_llama2, 0)) AS BIGINT) AS tokens FROM pool WHERE doc_id IS NOT NULL GROUP BY doc_id"),
    "final_once": ("", "SELECT orig_doc_id, source_prompt, min(text) AS text, CAST(min(coalesce(tokens_llama2, 0)) AS BIGINT) AS tokens FROM final GROUP BY orig_doc_id, source_prompt"),
    "calibration": ("passes scored", """SELECT p.setting, p.pass_name, p.shard_index, count(*) AS n_rows, CAST(sum(s.len) AS BIGINT) AS src_tokens, CAST(coalesce(sum(CASE WHEN status = 2 THEN s.len END), 0) AS BIGINT) AS src_done_tokens,
        CAST(coalesce(sum(CASE WHEN status = 2 THEN coalesce(rewritten_tokens, 0) END), 0) AS BIGINT) AS out_tokens, count(CASE WHEN status = 2 THEN 1 END) AS docs_done
        FROM passes p JOIN scored s ON p.doc_id = s.doc_id GROUP BY ALL"""),
}
for _k, _s in (("c1", "s1"), ("c2", "s2"), ("c3", "s3")):
    _CTES[_k] = ("residual budget", f"""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY {_s} DESC, tie, doc_id) AS rn, coalesce(sum(len) OVER (ORDER BY {_s} DESC, tie, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_len
        FROM residual) WHERE rn = 1 OR before_len < (SELECT 2 * b FROM budget)""")
for _k, _order, _source, _goal in (
    ("uniform", "md5('42:draw_a:' || doc_id), doc_id", "residual", "2 * b"),
    ("oversample", "md5('42:draw_b:' || doc_id), doc_id", "residual", "4 * b"),
    ("disagree", "u DESC, tie, doc_id", "feasible", "2 * b"),
):
    _CTES[_k] = (f"{_source} budget", f"""SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {_order}) AS rn, CAST(coalesce(sum(len) OVER (ORDER BY {_order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_len
        FROM {_source}) WHERE rn = 1 OR before_len < (SELECT {_goal} FROM budget)""")


def assembled(setting: str, key: str, group: str = "") -> str:
    """A second-budget fill of one setting; the target is the budget, of a group its part by the source's tokens."""
    part = f"PARTITION BY k.{group} " if group else ""
    source, target = (f"(SELECT keyed.*, t.target FROM keyed JOIN asm_topic_target t ON t.{group} = keyed.{group}) k", "target") if group else ("keyed k", "(SELECT CAST(b AS DOUBLE) FROM budget)")
    return f"""SELECT * FROM (SELECT k.* {"EXCLUDE (target)" if group else ""}, row_number() OVER ({part}ORDER BY tier, {key}, doc_id, rewrite_id) AS rn, {target} AS target,
        CAST(coalesce(sum(len) OVER ({part}ORDER BY tier, {key}, doc_id, rewrite_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_len
        FROM {source} WHERE setting = '{setting}') WHERE rn = 1 OR before_len < target"""


_CTES["sources"] = ("passes scored", "SELECT p.setting, p.doc_id, len, topic FROM (SELECT DISTINCT setting, doc_id FROM passes) p JOIN (SELECT doc_id, len, topic FROM scored) s ON p.doc_id = s.doc_id")
_CTES["asm_topic_target"] = ("sources budget", "SELECT topic, CAST((SELECT b FROM budget) AS DOUBLE) * CAST(sum(len) AS DOUBLE) / (SELECT CAST(sum(len) AS DOUBLE) FROM sources WHERE setting = 'topic_quota') AS target FROM sources WHERE setting = 'topic_quota' GROUP BY topic")
_CTES["asm_keyed"] = ("keyed budget", assembled("quality_prefix", "s1 DESC"))
_CTES["asm_spread"] = ("keyed budget", assembled("disagreement", "u DESC"))
_CTES["asm_random"] = ("keyed budget", assembled("styled_random", "substr(md5('42:topup:' || rewrite_id), 1, 12)"))
_CTES["asm_topic"] = ("keyed asm_topic_target", assembled("topic_quota", "s1 DESC", "topic"))
_CTES["listed"] = ("budget", "SELECT coalesce(lower(trim(topic)), '(none)') AS topic, max(target_share) * 2 * (SELECT b FROM budget) AS quota FROM topic_targets WHERE topic IS NOT NULL GROUP BY 1")
_CTES["listed_fill"] = ("residual listed", """SELECT *, false AS topped_up FROM (SELECT r.*, quota, row_number() OVER (PARTITION BY r.topic ORDER BY q DESC, tie, doc_id) AS rn,
        CAST(coalesce(sum(len) OVER (PARTITION BY r.topic ORDER BY q DESC, tie, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_len
        FROM residual r JOIN listed t ON r.topic = t.topic) WHERE rn = 1 OR before_len < quota""")
_CTES["listed_missing"] = ("listed_fill budget", "SELECT 2 * (SELECT b FROM budget) - CAST((SELECT coalesce(sum(len), 0) FROM listed_fill) AS BIGINT) AS m")
_CTES["listed_topup"] = ("listed_missing residual listed_fill", """SELECT * FROM (SELECT *, row_number() OVER (ORDER BY q DESC, tie, doc_id) AS rn, CAST(coalesce(sum(len) OVER (ORDER BY q DESC, tie, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_len
        FROM residual WHERE doc_id NOT IN (SELECT doc_id FROM listed_fill)) WHERE (SELECT m FROM listed_missing) > 0 AND (rn = 1 OR before_len < (SELECT m FROM listed_missing))""")


_CTES["pilot_state"] = ("passes", """SELECT p.setting, CASE WHEN coalesce(n, 0) = 0 THEN 'missing' WHEN n < p.n_docs THEN 'partial' WHEN lo < doc_id_min OR hi > doc_id_max THEN 'misaligned' WHEN n > p.n_docs THEN 'surplus' ELSE 'complete' END AS state
    FROM (SELECT setting, shard_index, CAST(n_docs AS BIGINT) AS n_docs, doc_id_min, doc_id_max, pass_name FROM shard_plan, (VALUES ('p1'), ('distill')) k(pass_name)) p
    LEFT JOIN (SELECT setting, shard_index, pass_name, count(*) AS n, min(doc_id) AS lo, max(doc_id) AS hi FROM passes GROUP BY ALL) r ON r.setting = p.setting AND r.shard_index = p.shard_index AND r.pass_name = p.pass_name""")
_CTES["yields"] = ("calibration", """SELECT setting, round(100.0 * ((max(CASE WHEN pass_name = 'p1' THEN r END) + max(CASE WHEN pass_name = 'distill' THEN r END)) * 2 - 1), 4) AS headroom_pct
    FROM (SELECT setting, pass_name, round(sum(out_tokens) / greatest(1, sum(src_tokens)), 6) AS r FROM calibration GROUP BY setting, pass_name) GROUP BY setting""")


def sql(query: str, needs: str = "") -> str:
    """The query with the common tables it needs in front."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for need in _CTES[name][0].split():
                add(need)
            order.append(name)

    for name in needs.split():
        add(name)
    if not order:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in order) + "\n" + query


# ---------------------------------------------------------------- text rules in SQL


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'" if "\n" not in s else "(" + " || chr(10) || ".join(_lit(p) for p in s.split("\n")) + ")"


def _starts(x: str, prefixes: list[str]) -> str:
    return "(" + " OR ".join(f"starts_with({x}, {_lit(p)})" for p in prefixes) + ")"


def _has(x: str, parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {_lit(p)})" for p in parts) + ")"


GAP, LINE = "strpos({t}, chr(10) || chr(10))", "strpos({t}, chr(10))"


def strip_leak(t: str) -> str:
    gap = GAP.format(t=t)
    return f"CASE WHEN starts_with({t}, {_lit(rules.LEAK)}) THEN CASE WHEN {gap} > 0 THEN substr({t}, {gap} + 2) ELSE '' END ELSE {t} END"


def strip_prefix(t: str) -> str:
    return strip_leak(f"(CASE WHEN starts_with({t}, {_lit(rules.PREFIX)}) THEN substr({t}, {len(rules.PREFIX) + 1}) ELSE {t} END)")


def strip_distill(t: str) -> str:
    gap, line = GAP.format(t=t), LINE.format(t=t)
    head = f"regexp_replace(substr({t}, 1, greatest({gap} - 1, 0)), '^\\s+|\\s+$', '', 'g')"
    first = f"regexp_replace(substr({t}, 1, greatest({line} - 1, 0)), '^\\s+|\\s+$', '', 'g')"
    low, low1 = f"lower({head})", f"lower({first})"
    paragraph = f"{gap} > 0 AND {gap} - 1 <= {rules.DISTILL_REACH} AND ((({_starts(head, rules.HEADERS)} OR {_starts(low, rules.DISTILL_OPENERS)}) AND {_has(low, rules.DISTILL_WORDS)}) OR (starts_with({low}, 'paraphrased') AND suffix({head}, ':')))"
    one = f"{line} > 0 AND {line} - 1 <= {rules.DISTILL_REACH} AND suffix({first}, ':') AND {_has(low1, rules.DISTILL_WORDS)} AND ({_starts(first, rules.HEADERS)} OR {_starts(low1, [*rules.DISTILL_OPENERS, 'paraphrased'])})"
    return f"CASE WHEN {paragraph} THEN substr({t}, {gap} + 2) WHEN {one} THEN regexp_replace(substr({t}, {line} + 1), '^\\n+', '') ELSE {t} END"


def strip_styled(t: str) -> str:
    gap = GAP.format(t=t)
    head = f"substr({t}, 1, greatest({gap} - 1, 0))"
    low = f"lower({head})"
    opener = f"({_starts(head, rules.STYLED_OPENERS)} AND {_has(low, rules.STYLED_WORDS)})"
    lead = f"regexp_replace({head}, '^\\s+', '')"
    label = f"(({_starts(lead, rules.HEADERS)} OR {_starts(low, ['paraphrased', 'rewritten passage'])}) AND {_has(low, rules.STYLED_STRICT)})"
    return f"CASE WHEN {gap} > 0 AND {gap} - 1 <= {rules.STYLED_REACH} AND ({opener} OR {label}) THEN substr({t}, {gap} + 2) ELSE {t} END"


def strip_by(setting: str, pass_name: str, t: str) -> str:
    return f"CASE WHEN {setting} = 'styled_random' THEN {strip_styled(t)} WHEN {pass_name} = 'p1' THEN {strip_prefix(t)} ELSE {strip_distill(t)} END"


def word_set(t: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array(lower(coalesce({t}, '')), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: w <> ''))"


def word_count(t: str) -> str:
    return f"CAST(len(list_filter(regexp_split_to_array(coalesce({t}, ''), '[ \\t\\n\\r]+'), lambda w: w <> '')) AS BIGINT)"
