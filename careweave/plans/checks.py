"""The same results in DuckDB SQL, written from the definitions of the operators."""

from __future__ import annotations

from careweave import fixed_values as fv
from careweave.plans import catalog as c, evaluation
from careweave.sources import tables

BRAND = tables.BRAND
WORD = r"[\p{L}\p{N}_\p{M}]{2,}"


# --- SQL text helpers ----------------------------------------------------------------

def q(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"{value!r}::DOUBLE"
    return "'" + value.replace("'", "''") + "'"


def rnd(x: str, digits: int = 4) -> str:
    return f"CAST(printf('%.{digits}f', CAST({x} AS DOUBLE)) AS DOUBLE)"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def norm(x: str) -> str:
    bare = strip(f"coalesce({x}, '')")
    return f"CASE WHEN {bare} IN ('nan', 'None') THEN '' ELSE {bare} END"


def clean(x: str) -> str:
    return (
        rf"trim(regexp_replace(regexp_replace(regexp_replace(coalesce({x}, ''), "
        rf"'https?://\S+|www\.\S+', '[URL]', 'g'), '@[A-Za-z0-9_]+', '', 'g'), '\s+', ' ', 'g'))")


def key(x: str) -> str:
    return f"lower({strip(x)})"


def toks(x: str) -> str:
    return rf"list_filter(string_split_regex({x}, '\s+'), lambda t: t <> '')"


def has(x: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({x}, '')), {q(w)})" for w in words) + ")"


def label(x: str, rules, default=fv.GENERAL_INTENT) -> str:
    cases = " ".join(f"WHEN {has(x, words)} THEN {q(name)}" for name, words in rules.items())
    return f"CASE {cases} ELSE {q(default)} END"


def votes(x: str, words) -> str:
    return "(" + " + ".join(f"contains(lower({x}), {q(w)})::INT" for w in words) + ")"


def vote_share(x: str, rules) -> str:
    total = " + ".join(votes(x, w) for w in rules.values())
    cases = " ".join(
        f"WHEN {votes(x, w)} > 0 THEN {votes(x, w)}::DOUBLE / ({total})" for w in rules.values())
    return f"CASE {cases} ELSE {fv.UNTRAINED_CONFIDENCE}::DOUBLE END"


def lookup(x: str, mapping, default) -> str:
    cases = " ".join(f"WHEN {x} = {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {cases} ELSE {q(default)} END"


def nth(values, index: str) -> str:
    return "[" + ", ".join(q(v) for v in values) + f"][({index}) + 1]"


def hits(x: str, words) -> str:
    listed = ", ".join(f"CASE WHEN contains(lower({x}), {q(w)}) THEN {q(w)} END" for w in words)
    return f"list_filter([{listed}], lambda h: h IS NOT NULL)"


def in_list(x: str, values) -> str:
    return f"{x} IN (" + ", ".join(q(v) for v in values) + ")"


def fill(template: str, order: str, days: str, amount: str) -> str:
    return (f"replace(replace(replace({template}, '{{id}}', {order}), '{{days}}', "
            f"CAST({days} AS VARCHAR)), '{{amt}}', printf('%d.99', {amount}))")


# --- named steps ------------------------------------------------------------------

_STEPS: dict[str, tuple[tuple[str, ...], str]] = {}


def step(name: str, uses: str, sql: str) -> None:
    _STEPS[name] = (tuple(uses.split()), sql)


def full(select: str, uses: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for other in _STEPS[name][0]:
            add(other)
        if name not in order:
            order.append(name)

    for name in uses.split():
        add(name)
    if not order:
        return select
    return "WITH " + ",\n".join(
        f"{n} AS MATERIALIZED ({_STEPS[n][1]})" for n in order) + "\n" + select


step("msgs", "", f"""
  SELECT conv_id || '-' || turn AS tweet_id,
         CASE WHEN role = 'assistant' THEN {q(BRAND)} ELSE role || '_' || conv_id END AS author_id,
         CASE WHEN turn > 0 THEN conv_id || '-' || (turn - 1) ELSE '' END AS in_reply_to_tweet_id,
         printf('%06d', turn) AS created_at, {norm('text')} AS text
  FROM conversations""")
step("clean", "msgs", f"""
  SELECT * FROM (
    SELECT *, text AS raw_text, {clean('text')} AS clean_text,
           lower(author_id) = lower({q(BRAND)}) AS is_brand,
           lower(author_id) <> lower({q(BRAND)}) AS is_customer
    FROM msgs WHERE {strip('text')} <> '')
  WHERE clean_text <> ''""")
step("pairs", "clean", f"""
  SELECT p.tweet_id || '_' || r.tweet_id AS pair_id,
         p.tweet_id AS customer_tweet_id, p.author_id AS customer_author_id,
         p.raw_text AS customer_query, p.clean_text AS customer_clean_text,
         r.tweet_id AS support_tweet_id, r.author_id AS support_author_id,
         r.raw_text AS support_response, r.clean_text AS support_clean_text,
         r.created_at AS created_at
  FROM clean r JOIN clean p ON r.in_reply_to_tweet_id = p.tweet_id
  WHERE r.is_brand AND NOT p.is_brand AND len({toks('p.clean_text')}) >= {fv.MIN_TOKENS}
    AND len({toks('r.clean_text')}) >= {fv.MIN_TOKENS}
  QUALIFY row_number() OVER (PARTITION BY p.clean_text, r.clean_text
                             ORDER BY r.created_at, r.tweet_id) = 1""")

_GEN = [t for t in zip(*fv.TRAINING_TEMPLATES)]
step("gen", "", f"""
  SELECT printf('train_hist_%04d', i) AS pair_id, printf('tw_tr_%04d', i) AS customer_tweet_id,
         printf('user_tr_%04d', i) AS customer_author_id, t AS customer_query,
         t AS customer_clean_text, printf('tw_supp_%04d', i) AS support_tweet_id,
         {q(fv.DEFAULT_BRAND)} AS support_author_id, a AS support_response,
         a AS support_clean_text, {q(fv.TRAINING_CREATED_AT)} AS created_at, intent
  FROM (SELECT doc_id AS i,
          {fill(nth(_GEN[1], 'doc_id % 14'), "printf('40%03d-8%05d', doc_id + 100, doc_id * 5)",
                '(doc_id % 4) + 2', '(doc_id * 11) % 70 + 15')} AS t,
          {nth(_GEN[2], 'doc_id % 14')} AS a, {nth(_GEN[0], 'doc_id % 14')} AS intent
        FROM documents)""")
_GOLD = [t for t in zip(*fv.GOLDEN_TEMPLATES)]
_WRITTEN = ", ".join(
    f"({i + 1}, " + ", ".join(q(v) for v in row) + ")" for i, row in enumerate(fv.GOLDEN_LITERALS))
_NAMES = ("pair_id, customer_tweet_id, customer_clean_text, support_response, gold_intent, "
          "gold_should_escalate, human_quality_rating")
step("gold_items", "", f"""
  SELECT {_NAMES} FROM (VALUES {_WRITTEN}) AS w(pos, {_NAMES})
  JOIN (SELECT doc_id + 1 AS i FROM documents) ON i = pos
  UNION ALL
  SELECT printf('pair_gold_%03d', i), printf('tw_gold_%03d', i),
         {fill(nth(_GOLD[1], '(i - 19) % 15'), "printf('40%d-9%05d', i, i * 3)",
               '(i % 5) + 2', '(i * 7) % 80 + 19')},
         {q(fv.GOLDEN_TEMPLATE_REPLY)}, {nth(_GOLD[0], '(i - 19) % 15')},
         {nth(_GOLD[2], '(i - 19) % 15')}, {nth(_GOLD[3], '(i - 19) % 15')}
  FROM (SELECT doc_id + 1 AS i FROM documents) WHERE i > 18""")

# Retrieval over the paired questions.
step("tf", "pairs", f"""
  SELECT pair_id, term, count(*) AS tf
  FROM (SELECT pair_id, unnest(regexp_extract_all(lower(customer_clean_text), '{WORD}')) AS term
        FROM pairs)
  WHERE NOT {in_list('term', c.STOP_WORDS)} GROUP BY ALL""")
step("terms", "tf", f"""
  SELECT term, ln((1.0 + (SELECT count(*) FROM pairs)) / (1.0 + df)) + 1.0 AS idf
  FROM (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term
        ORDER BY total DESC, term LIMIT {fv.MAX_FEATURES})""")
step("weights", "tf terms", """
  SELECT pair_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY pair_id)) AS w
  FROM (SELECT pair_id, term, tf * idf AS w FROM tf JOIN terms USING (term))""")
step("sims", "weights", f"""
  SELECT a.pair_id AS query_id, b.pair_id AS case_id,
         {rnd('greatest(0.0, coalesce(dot, 0.0))')} AS similarity_score,
         a.customer_tweet_id IN (b.customer_tweet_id, b.support_tweet_id)
           OR {key('a.customer_clean_text')} = {key('b.customer_clean_text')} AS own
  FROM pairs a CROSS JOIN pairs b LEFT JOIN (
    SELECT x.pair_id AS qi, y.pair_id AS ci, sum(x.w * y.w) AS dot
    FROM weights x JOIN weights y USING (term) GROUP BY ALL) ON qi = a.pair_id AND ci = b.pair_id""")


def ranked(source: str, k: int) -> str:
    return f"""
  SELECT query_id, CAST(row_number() OVER (
           PARTITION BY query_id ORDER BY similarity_score DESC, case_id) AS INT) AS rank,
         case_id, similarity_score
  FROM {source} QUALIFY rank <= {k}"""


step("cases", "sims", ranked("(SELECT * FROM sims WHERE NOT own)", fv.TOP_K))
step("attached", "cases", f"""
  SELECT p.*, {label('p.customer_clean_text', tables.LANGUAGE_RULES)} AS predicted_intent,
         {fv.UNTRAINED_CONFIDENCE}::DOUBLE AS confidence, b.support_response AS top_response,
         coalesce(t.similarity_score, 0.0::DOUBLE) AS top_retrieval_sim,
         t.case_id IS NOT NULL AS has_case
  FROM pairs p LEFT JOIN cases t ON t.query_id = p.pair_id AND t.rank = 1
  LEFT JOIN pairs b ON b.pair_id = t.case_id""")


def routed(source: str, min_sim: float) -> str:
    w = fv.RISK_WEIGHTS
    kw = hits("customer_clean_text", fv.RISK_KEYWORDS)
    return f"""
  SELECT *, CASE WHEN should_escalate THEN {q(fv.ACTION_ESCALATE)} ELSE {q(fv.ACTION_AUTO)} END
             AS routing_action,
         NOT should_escalate AS system_auto_handled,
         least(10, tenths) / 10.0::DOUBLE AS risk_score,
         CASE WHEN len(reasons) = 0 THEN {q(fv.NO_REASON)}
              ELSE array_to_string(reasons, '; ') END AS primary_reason
  FROM (
    SELECT *, tenths >= 5 OR len(reasons) >= 2 OR len(kw) > 0 AS should_escalate
    FROM (
      SELECT *, (len(kw) > 0)::INT * {round(w['keywords'] * 10)} + s2::INT * {round(w['sensitive'] * 10)}
                + s3::INT * {round(w['confidence'] * 10)} + s4::INT * {round(w['evidence'] * 10)}
                + s5::INT * {round(w['general'] * 10)} AS tenths,
        list_filter([
          CASE WHEN len(kw) > 0 THEN 'Contains security/legal risk keywords: [''' ||
            array_to_string(kw, ''', ''') || ''']' END,
          CASE WHEN s2 THEN 'Intent ''' || predicted_intent ||
            ''' involves sensitive financial or credential actions' END,
          CASE WHEN s3 THEN 'Low intent classification confidence (' ||
            printf('%.2f', confidence) || ' < {fv.MIN_CONFIDENCE})' END,
          CASE WHEN s4 THEN 'Weak historical retrieval evidence (similarity ' ||
            printf('%.2f', top_retrieval_sim) || ' < {min_sim})' END,
          CASE WHEN s5 THEN 'Unclear/General query intent without high confidence pattern match' END
        ], lambda r: r IS NOT NULL) AS reasons
      FROM (SELECT *, {kw} AS kw, {in_list('predicted_intent', fv.SENSITIVE_INTENTS)} AS s2,
                   confidence < {fv.MIN_CONFIDENCE}::DOUBLE AS s3,
                   top_retrieval_sim < {min_sim}::DOUBLE AS s4,
                   predicted_intent = {q(fv.GENERAL_INTENT)}
                     AND confidence < {fv.GENERAL_MIN_CONFIDENCE}::DOUBLE AS s5
            FROM {source})))"""


def template_reply(intent: str, has_case: str) -> str:
    return (f"CASE WHEN {has_case} THEN {q(fv.REPLY_PREFIX)} || "
            f"{lookup(intent, fv.REPLY_TEMPLATES, fv.REPLY_TEMPLATES[fv.GENERAL_INTENT])} "
            f"ELSE {q(fv.TEMPLATE_FALLBACK_REPLY)} END")


def judged(source: str, intent: str) -> str:
    r, t = "generated_reply", "top_response"
    return f"""
  SELECT *, {rnd('(relevance + groundedness + helpfulness + tone + safety + 6 - hallucination_risk) / 6.0', 2)}
              AS overall_quality_score
  FROM (SELECT *,
      CASE WHEN vague THEN 3 WHEN g AND {in_list(intent, fv.SPECIFIC_RELEVANCE_INTENTS)} THEN 4
           ELSE 5 END AS relevance,
      CASE WHEN ({has(t, ['dm'])} AND {has(r, ['dm'])}) OR ({has(t, ['refund'])} AND {has(r, ['refund'])})
           THEN 5 ELSE 4 END AS groundedness,
      CASE WHEN vague OR (g AND {in_list(intent, fv.SPECIFIC_HELP_INTENTS)}) THEN 3
           WHEN {has(r, fv.HELP_WORDS)} THEN 5 ELSE 3 END AS helpfulness,
      CASE WHEN {has(r, fv.POLITE_WORDS)} THEN 5 ELSE 4 END AS tone,
      CASE WHEN {has(r, fv.UNSAFE_WORDS)} THEN 1
           WHEN NOT g AND {has('customer_clean_text', fv.PRIVATE_QUERY_WORDS)} THEN 3 ELSE 5 END AS safety,
      CASE WHEN {has(r, fv.PROMISE_PHRASES)} THEN 5 ELSE 1 END AS hallucination_risk
    FROM (SELECT *, g AND {in_list(intent, fv.VAGUE_INTENTS)} AS vague
          FROM (SELECT *, {has(r, fv.GENERIC_PHRASES)} AND len({toks(r)}) <= {fv.GENERIC_MAX_TOKENS} AS g
                FROM {source})))"""


step("routed", "attached", routed("attached", c.MIN_SIM))
step("scored", "routed", judged(
    f"(SELECT *, {template_reply('predicted_intent', 'has_case')} AS generated_reply FROM routed)",
    "predicted_intent"))

# The stream's questions (all messages that are not the brand's) against the same index.
step("asked", "msgs", f"""
  SELECT tweet_id, {clean('text')} AS customer_clean_text FROM msgs
  WHERE lower(author_id) <> lower({q(BRAND)})""")
step("asked_weights", "asked terms", f"""
  SELECT tweet_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY tweet_id)) AS w
  FROM (SELECT tweet_id, term, count(*) * any_value(idf) AS w
        FROM (SELECT tweet_id, unnest(regexp_extract_all(lower(customer_clean_text), '{WORD}')) AS term
              FROM asked) JOIN terms USING (term) GROUP BY ALL)""")
step("asked_cases", "asked_weights weights", f"""
  SELECT a.tweet_id AS query_id, b.pair_id AS case_id,
         {rnd('greatest(0.0, coalesce(dot, 0.0))')} AS similarity_score
  FROM asked a CROSS JOIN pairs b LEFT JOIN (
    SELECT x.tweet_id AS qi, y.pair_id AS ci, sum(x.w * y.w) AS dot
    FROM asked_weights x JOIN weights y USING (term) GROUP BY ALL)
  ON qi = a.tweet_id AND ci = b.pair_id
  WHERE a.tweet_id NOT IN (b.customer_tweet_id, b.support_tweet_id)
    AND {key('a.customer_clean_text')} <> {key('b.customer_clean_text')}
  QUALIFY row_number() OVER (PARTITION BY a.tweet_id ORDER BY similarity_score DESC, b.pair_id) = 1""")
step("asked_routes", "asked_cases", routed(f"""
  (SELECT a.tweet_id AS customer_tweet_id, a.customer_clean_text,
          {label('a.customer_clean_text', tables.LANGUAGE_RULES)} AS predicted_intent,
          {fv.UNTRAINED_CONFIDENCE}::DOUBLE AS confidence, b.support_response AS top_response,
          coalesce(t.similarity_score, 0.0::DOUBLE) AS top_retrieval_sim,
          t.case_id IS NOT NULL AS has_case
   FROM asked a LEFT JOIN asked_cases t ON t.query_id = a.tweet_id
   LEFT JOIN pairs b ON b.pair_id = t.case_id)""", c.MIN_SIM))
step("asked_scores", "asked_routes", judged(
    f"(SELECT *, {template_reply('predicted_intent', 'has_case')} AS generated_reply FROM asked_routes)",
    "predicted_intent"))

_BY_SYSTEM = dict(zip(fv.REPLY_SYSTEMS, [
    q(fv.TRIVIAL_REPLY), f"coalesce(nullif(top_response, ''), {q(fv.NEAREST_FALLBACK_REPLY)})",
    template_reply("predicted_intent", "has_case")]))
step("systems", "attached", " UNION ALL ".join(
    f"SELECT *, {q(name)} AS system, {sql} AS generated_reply FROM attached"
    for name, sql in _BY_SYSTEM.items()))
step("judged_systems", "systems", judged("systems", "predicted_intent"))


def lcs(a: str, b: str) -> str:
    """Row-by-row dynamic programme over two token lists."""
    return f"""list_reduce(
      list_transform({a}, lambda x: list_transform({b}, lambda y: (x = y)::BIGINT)),
      lambda r, m: list_reduce(
        list_transform(range(1, len(m) + 1), lambda j: [j::BIGINT]),
        lambda s, jj: list_append(s, CASE WHEN m[jj[1]] = 1 THEN r[jj[1]] + 1
                                          ELSE greatest(s[len(s)], r[jj[1] + 1]) END),
        [0::BIGINT]),
      list_transform(range(0, len({b}) + 1), lambda z: 0::BIGINT))[len({b}) + 1]"""


def lexical(source: str, ref: str, gen: str) -> str:
    return f"""
  SELECT *, len(list_filter(gt, lambda t: list_contains(rt, t)))::DOUBLE / greatest(1, len(gt)) AS bleu_4,
         2.0 * (l / greatest(1, len(gt))::DOUBLE) * (l / greatest(1, len(rt))::DOUBLE)
           / greatest(1e-6::DOUBLE, l / greatest(1, len(gt))::DOUBLE + l / greatest(1, len(rt))::DOUBLE)
           AS rouge_l
  FROM (SELECT *, {lcs('rt', 'gt')} AS l
        FROM (SELECT *, {toks(f'lower({ref})')} AS rt, {toks(f'lower({gen})')} AS gt FROM {source}))"""


step("system_scores", "judged_systems", lexical("judged_systems", "support_response", "generated_reply"))
step("compared", "system_scores", f"""
  SELECT system,
         {rnd("sum(CAST(overall_quality_score AS DECIMAL(10,2)))::DOUBLE / count(*)")} AS overall_quality_score,
         {", ".join(f"{rnd(f'sum({s})::DOUBLE / count(*)')} AS {s}" for s in fv.RUBRIC_SCORES)},
         {rnd('avg(bleu_4)')} AS secondary_bleu_4, {rnd('avg(rouge_l)')} AS secondary_rouge_l,
         count(*) AS n
  FROM system_scores GROUP BY system""")

# Documents as a labelled test set.
step("docs", "", f"""
  SELECT doc_id, {clean('text')} AS customer_clean_text,
         {lookup('lang', tables.LANGUAGE_INTENTS, fv.GENERAL_INTENT)} AS gold_intent,
         {label('text', tables.LANGUAGE_RULES)} AS predicted_intent,
         {vote_share('text', tables.LANGUAGE_RULES)} AS confidence,
         {rnd('least(1.0, n_chars / 1000.0)')} AS top_retrieval_sim
  FROM documents""")
step("doc_routes", "docs", routed("docs", fv.MIN_RETRIEVAL_SIM))
step("preds", "doc_routes", judged(f"""
  (SELECT r.*, r.doc_id::VARCHAR AS pair_id, NULL::VARCHAR AS top_response,
          quality = 0 OR toxic = 1 AS gold_should_escalate,
          {template_reply('predicted_intent', 'true')} AS generated_reply
   FROM doc_routes r JOIN labels USING (doc_id))""", "predicted_intent"))
_F = fv.FAILURE_TEXTS
_WRONG, _UNSAFE, _LOW, _OVER = _F
step("failed", "preds", f"""
  SELECT *, {lookup('failure_type', {k: v[0] for k, v in _F.items()}, '')} AS likely_cause,
         {lookup('failure_type', {k: v[1] for k, v in _F.items()}, '')} AS potential_improvement,
         CASE WHEN failure_type = {q(_WRONG)} THEN 'Predicted intent ''' || predicted_intent ||
                ''' instead of true gold intent ''' || gold_intent || '''.'
              WHEN failure_type = {q(_UNSAFE)} THEN 'System auto-handled a query requiring human escalation.'
              WHEN failure_type = {q(_LOW)} THEN 'Judge rating of ' || overall_quality_score ||
                '/5.0 indicates sub-optimal resolution response.'
              ELSE 'Straightforward query escalated to human agent, reducing automation efficiency.'
         END AS what_failed,
         CASE WHEN gold_intent = 'PRIME_SUBSCRIPTION' AND predicted_intent = 'DELIVERY_STATUS'
                THEN {q(fv.SUB_PRIME_DELIVERY)}
              WHEN gold_intent = 'REFUND_RETURN' AND predicted_intent = 'PAYMENT_CHARGE'
                THEN {q(fv.SUB_REFUND_CHARGE)}
              WHEN {rnd('confidence')} < {fv.SUB_CONFIDENCE} THEN {q(fv.SUB_LOW_CONFIDENCE)}
              ELSE {q(fv.SUB_OTHER)} END AS empirical_subcategory
  FROM (SELECT *, CASE WHEN gold_intent <> predicted_intent THEN {q(_WRONG)}
                       WHEN gold_should_escalate AND system_auto_handled THEN {q(_UNSAFE)}
                       WHEN overall_quality_score < 3.5 THEN {q(_LOW)}
                       WHEN NOT gold_should_escalate AND NOT system_auto_handled AND confidence > 0.8
                         THEN {q(_OVER)} END AS failure_type FROM preds)
  WHERE failure_type IS NOT NULL""")
step("train", "", f"SELECT doc_id, text, lang, {key('text')} AS k FROM documents "
                  "WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
step("golden", "", f"SELECT doc_id, text, lang, {key('text')} AS k FROM documents "
                   "WHERE doc_id IN (SELECT doc_id FROM labels)")
step("cm", "docs", """
  SELECT gold_intent AS gold, predicted_intent AS predicted, count(*) AS n FROM docs GROUP BY ALL""")
step("cm_majority", "docs", """
  SELECT gold_intent AS gold, (SELECT gold_intent FROM docs GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
         AS predicted, count(*) AS n FROM docs GROUP BY ALL""")
for _of in ("", "_majority"):
    step(f"per_class{_of}", f"cm{_of}", f"""
      SELECT label, coalesce(tp, 0) AS tp, coalesce(np, 0) AS np, coalesce(ng, 0) AS ng,
             coalesce(coalesce(tp, 0)::DOUBLE / nullif(np, 0), 0) AS precision,
             coalesce(coalesce(tp, 0)::DOUBLE / nullif(ng, 0), 0) AS recall,
             2.0 * coalesce(tp, 0) / (coalesce(np, 0) + coalesce(ng, 0)) AS f1
      FROM (SELECT DISTINCT unnest([gold, predicted]) AS label FROM cm{_of})
      LEFT JOIN (SELECT gold AS label, sum(n) AS tp FROM cm{_of} WHERE gold = predicted GROUP BY 1) USING (label)
      LEFT JOIN (SELECT predicted AS label, sum(n) AS np FROM cm{_of} GROUP BY 1) USING (label)
      LEFT JOIN (SELECT gold AS label, sum(n) AS ng FROM cm{_of} GROUP BY 1) USING (label)""")
    step(f"cls{_of}", f"per_class{_of}", f"""
      SELECT {rnd('sum(tp)::DOUBLE / sum(ng)')} AS accuracy, {rnd('avg(precision)')} AS macro_precision,
             {rnd('avg(recall)')} AS macro_recall, {rnd('avg(f1)')} AS macro_f1,
             {rnd('sum(f1 * ng) / sum(ng)')} AS weighted_f1 FROM per_class{_of}""")
step("trust", "preds", f"""
  SELECT {rnd('unsafe / greatest(1, gold)::DOUBLE')} AS unsafe_auto_handle_rate,
         {rnd('auto / total::DOUBLE')} AS automation_rate,
         {rnd('(total - auto) / total::DOUBLE')} AS escalation_share,
         {rnd('coalesce(hit / nullif(total - auto, 0)::DOUBLE, 0)')} AS escalation_precision,
         {rnd('coalesce(hit / nullif(gold, 0)::DOUBLE, 0)')} AS escalation_recall,
         {rnd('coalesce(2.0 * hit / nullif(total - auto + gold, 0), 0)')} AS escalation_f1,
         total AS total_evaluated, gold AS gold_escalations_total, unsafe AS unsafe_auto_handles_count
  FROM (SELECT count(*) AS total, count(*) FILTER (gold_should_escalate) AS gold,
               count(*) FILTER (gold_should_escalate AND system_auto_handled) AS unsafe,
               count(*) FILTER (system_auto_handled) AS auto,
               count(*) FILTER (gold_should_escalate AND NOT system_auto_handled) AS hit
        FROM preds)""")
step("rated", "", """
  SELECT event_id AS id, 1.0::DOUBLE + json_extract_string(props, '$.k')::DOUBLE / 25.0::DOUBLE AS human,
         least(5.0::DOUBLE, greatest(1.0::DOUBLE, 1.0::DOUBLE + value / 100.0::DOUBLE)) AS judge
  FROM events""")
step("rated_first", "rated", f"SELECT * FROM rated ORDER BY id LIMIT {fv.RATED_SAMPLE}")
for _of in ("", "_first"):
    step(f"bins{_of}", f"rated{_of}", f"""
      SELECT *, least(5, greatest(1, round_even(human, 0)::INT)) AS bh,
             least(5, greatest(1, round_even(judge, 0)::INT)) AS bj,
             rank() OVER (ORDER BY human) + (count(*) OVER (PARTITION BY human) - 1) / 2.0 AS rh,
             rank() OVER (ORDER BY judge) + (count(*) OVER (PARTITION BY judge) - 1) / 2.0 AS rj
      FROM rated{_of}""")
    step(f"bin_index{_of}", f"bins{_of}", f"""
      SELECT b, row_number() OVER (ORDER BY b) AS i FROM (SELECT DISTINCT unnest([bh, bj]) AS b FROM bins{_of})""")
    step(f"kappa{_of}", f"bin_index{_of}", f"""
      SELECT coalesce(1 - sum(w * o) / nullif(sum(w * e), 0), 0) AS kappa
      FROM (SELECT power(x.i - y.i, 2) AS w,
              (SELECT count(*) FROM bins{_of} WHERE bh = x.b AND bj = y.b) AS o,
              (SELECT count(*) FROM bins{_of} WHERE bh = x.b)::DOUBLE
                * (SELECT count(*) FROM bins{_of} WHERE bj = y.b) / (SELECT count(*) FROM bins{_of}) AS e
            FROM bin_index{_of} x, bin_index{_of} y)""")
    step(f"agreed{_of}", f"kappa{_of}", f"""
      SELECT {rnd('corr(rh, rj)')} AS spearman_correlation,
             {rnd(f'(SELECT kappa FROM kappa{_of})')} AS weighted_cohens_kappa,
             {rnd('avg((bh = bj)::INT)')} AS exact_agreement,
             {rnd('avg((abs(bh - bj) <= 1)::INT)')} AS agreement_within_1_point,
             {rnd('corr(human, judge)')} AS pearson_correlation,
             {rnd('avg(abs(human - judge))')} AS mean_absolute_error, count(*) AS sample_size
      FROM bins{_of}""")
step("stats", "clean pairs", f"""
  SELECT {q(BRAND)} AS brand, count(*) AS total_tweets_inspected,
         count(*) FILTER (is_customer) AS customer_messages,
         count(*) FILTER (is_brand) AS brand_replies,
         (SELECT count(*) FROM pairs) AS usable_customer_support_pairs,
         (SELECT count(DISTINCT customer_tweet_id) FROM pairs) AS approximate_thread_count,
         {rnd('(SELECT count(*) FROM pairs)::DOUBLE / greatest(1, count(*) FILTER (is_customer))')}
           AS support_reply_ratio FROM clean""")
step("vecs", "", """
  SELECT vec_id, label, list_transform(v, lambda x: x / CASE WHEN n = 0 THEN 1e-10 ELSE n END) AS v
  FROM (SELECT *, sqrt(list_inner_product(v, v)) AS n
        FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))""")


def knn(where: str) -> str:
    return full(ranked(f"""(
    SELECT a.vec_id AS query_id, b.vec_id AS case_id,
           {rnd('greatest(0.0, list_inner_product(a.v, b.v))')} AS similarity_score
    FROM vecs a, vecs b WHERE {where})""", fv.TOP_K), "vecs")


_LSH = {"tables": 7, "bits": 5, "radius": 1, "dim": 64}
step("planes", "", f"""
  SELECT i // {_LSH['dim']} AS p, list(((x * x + 12345 * n) % 2147483647) / 2147483647.0 - 0.5 ORDER BY i) AS w
  FROM (SELECT i, i + {fv.SEED * 1_000_003} AS n, ((i + {fv.SEED * 1_000_003} + 1) * 48271) % 2147483647 AS x
        FROM range({_LSH['tables'] * _LSH['bits'] * _LSH['dim']}) r(i)) GROUP BY 1""")
step("codes", "vecs planes", f"""
  SELECT vec_id, any_value(v) AS v, p // {_LSH['bits']} AS t,
         sum((list_inner_product(v, w) >= 0)::INT << (p % {_LSH['bits']})::INT)::INT AS code
  FROM vecs, planes GROUP BY vec_id, t""")


def long(component: str, source: str, metrics, system: str = "'all'") -> str:
    return " UNION ALL ".join(
        f"SELECT {q(component)} AS component, {system} AS system, {q(m)} AS metric, "
        f"CAST({m} AS DOUBLE) AS value FROM {source}" for m in metrics)


_HASH = f"((doc_id % {2 ** 31}) * 2654435761 + {fv.SEED * 40503}) % {2 ** 32}"
_MEASURES = ["spearman_correlation", "weighted_cohens_kappa", "exact_agreement",
             "agreement_within_1_point", "pearson_correlation", "mean_absolute_error"]
_DIMENSIONS = fv.RUBRIC_SCORES[:-1]
_HEAD, _REST = fv.GROUNDED_PROMPT.split("{query}")
_MID, _REST = _REST.split("{intent}")
_BEFORE, _TAIL = _REST.split("{context}")
_SHORT = r"regexp_replace(printf('%.4f', s.similarity_score), '(\.\d+?)0+$', '\1')"
_FAILED = f"""
  SELECT pair_id, customer_clean_text AS customer_message, gold_intent, predicted_intent,
         {rnd('confidence')} AS confidence, routing_action AS routing_decision,
         coalesce(top_response, 'None') AS retrieved_case, generated_reply, failure_type,
         what_failed, likely_cause, potential_improvement FROM failed"""
_SUMMARY_USES = "cls cls_majority trust compared agreed stats failed"
_CLASSIFIED = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1"]
_SUMMARY = " UNION ALL ".join([
    long("intent_classification", "cls", _CLASSIFIED, "'keyword_rules'"),
    long("intent_classification", "cls_majority", _CLASSIFIED, "'baseline_0_majority'"),
    long("escalation_routing_trust", "trust", evaluation.TRUST_METRICS),
    long("reply_generation_systems", "compared", evaluation.REPLY_METRICS, "system"),
    long("human_vs_judge_agreement", "agreed", [*_MEASURES, "sample_size"]),
    long("dataset_info", "stats", evaluation.DATASET_METRICS),
    long("failure_analysis_summary", "(SELECT count(*) AS total_failures_identified FROM failed)",
         ["total_failures_identified"]),
])


def oracle_sql() -> dict[str, str]:
    gold = lookup("lang", tables.LANGUAGE_INTENTS, fv.GENERAL_INTENT)
    return {
        "scan_messages": full("SELECT * FROM msgs", "msgs"),
        "normalize_missing": f"SELECT doc_id, {norm('text')} AS text, {norm('lang')} AS lang, "
                             f"{norm('source')} AS source FROM documents",
        "row_cap": full(f"SELECT * FROM msgs ORDER BY created_at, tweet_id LIMIT {c.CAP_ROWS}", "msgs"),
        "gen_corpus": full("SELECT * FROM gen", "gen"),
        "gen_golden": full("SELECT * FROM gold_items", "gold_items"),
        "clean_text": f"""
          SELECT 'documents' AS origin, doc_id AS row_id, {clean('text')} AS clean_text FROM documents
          UNION ALL SELECT 'conversations', conv_id * 1000 + turn, {clean('text')} FROM conversations
          UNION ALL SELECT 'pages', page_id, {clean('url')} FROM pages""",
        "preprocess_messages": full(
            "SELECT tweet_id, raw_text, clean_text, is_brand, is_customer FROM clean", "clean"),
        "min_token_filter": f"SELECT doc_id, n_tokens::INT AS n_tokens FROM (SELECT doc_id, "
                            f"len({toks('text')}) AS n_tokens FROM documents) WHERE n_tokens >= 3",
        "keyword_label": f"""
          SELECT doc_id, {label('text', fv.KEYWORD_RULES)} AS default_label,
                 {label('text', tables.LANGUAGE_RULES)} AS language_label,
                 {rnd(vote_share('text', tables.LANGUAGE_RULES))} AS vote_share FROM documents""",
        "resolve_label": full(f"""
          SELECT pair_id, {label('customer_clean_text', tables.LANGUAGE_RULES)} AS intent FROM pairs
          UNION ALL SELECT pair_id, intent FROM gen""", "pairs gen"),
        "json_field": "SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS DOUBLE), "
                      "4.0::DOUBLE) AS k FROM events",
        "risk_keywords": full(f"""
          SELECT * FROM (
            SELECT 'documents' AS origin, doc_id::VARCHAR AS row_id,
                   array_to_string({hits('text', fv.RISK_KEYWORDS)}, ',') AS hits FROM documents
            UNION ALL SELECT 'messages', tweet_id,
                   array_to_string({hits('text', fv.RISK_KEYWORDS)}, ',') FROM msgs)
          WHERE hits <> ''""", "msgs"),
        "dedup_pairs": f"""
          SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (
            PARTITION BY {key(clean('text'))}, lang ORDER BY doc_id) = 1""",
        "sample_n": f"SELECT doc_id, lang FROM documents ORDER BY {_HASH}, doc_id LIMIT {c.SAMPLE_ROWS}",
        "sample_stratified": f"""
          SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (
            PARTITION BY lang ORDER BY {_HASH}, doc_id) <= {c.STRATUM_ROWS}""",
        "reconstruct_pairs": full("SELECT * FROM pairs", "pairs"),
        "brand_stats": full("SELECT * FROM stats", "stats"),
        "thread_sketches": full("""
          SELECT created_at, count(DISTINCT customer_tweet_id) AS exact, count(*) AS pairs, true AS near
          FROM pairs GROUP BY 1
          UNION ALL SELECT 'all', count(DISTINCT customer_tweet_id), count(*), true FROM pairs""", "pairs"),
        "supplement_union": full(f"""
          SELECT pair_id, customer_clean_text, support_clean_text, NULL::VARCHAR AS intent FROM pairs
          UNION ALL
          SELECT printf('train_hist_%04d', i),
            {fill(nth(_GEN[1], 'i % 14'), "printf('40%03d-8%05d', i + 100, i * 5)",
                  '(i % 4) + 2', '(i * 11) % 70 + 15')}, {nth(_GEN[2], 'i % 14')}, {nth(_GEN[0], 'i % 14')}
          FROM range({fv.SUPPLEMENT_ROWS}) AS r(i)
          WHERE (SELECT count(*) FROM pairs) < {c.SUPPLEMENT_BELOW}""", "pairs"),
        "exclude_golden": full(
            "SELECT doc_id, lang FROM train WHERE k NOT IN (SELECT k FROM golden)", "train golden"),
        "leak_check": full(
            "SELECT doc_id, lang FROM golden WHERE k IN (SELECT k FROM train)", "train golden"),
        "mask_pairs": full("SELECT query_id, case_id, similarity_score FROM cases", "cases"),
        "reply_leakage": full(f"""
          SELECT s.query_id, s.case_id,
                 NOT ({key('a.support_response')} <> '' AND {key('b.support_response')} <> ''
                      AND {key('a.support_response')} = {key('b.support_response')}) AS is_safe
          FROM cases s JOIN pairs a ON a.pair_id = s.query_id JOIN pairs b ON b.pair_id = s.case_id""",
                              "cases"),
        "l2_normalize": full(f"""
          SELECT vec_id, (unnest(range(1, 65)) - 1)::INT AS position,
                 {rnd('unnest(v)', 6)} AS x FROM vecs""", "vecs"),
        "knn_topk": knn("true"),
        "knn_lsh": full(ranked(f"""(
          SELECT a.vec_id AS query_id, b.vec_id AS case_id,
                 {rnd('greatest(0.0, list_inner_product(any_value(a.v), any_value(b.v)))')} AS similarity_score
          FROM codes a JOIN codes b ON a.t = b.t AND a.vec_id <> b.vec_id
               AND bit_count(xor(a.code, b.code)) <= {_LSH['radius']}
          GROUP BY a.vec_id, b.vec_id)""", fv.TOP_K), "codes"),
        "knn_masked": knn("a.vec_id <> b.vec_id AND a.label <> b.label"),
        "tfidf_terms": f"""
          SELECT term, df, total::BIGINT AS total,
                 {rnd('ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0')} AS idf
          FROM (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS total
                FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS term
                      FROM documents)
                WHERE NOT {in_list('term', c.STOP_WORDS)} GROUP BY term
                ORDER BY total DESC, term LIMIT {fv.MAX_FEATURES})""",
        "ngram_terms": f"""
          WITH w AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{WORD}'),
                                                lambda x: NOT {in_list('x', c.STOP_WORDS)}) AS w
                     FROM documents),
          t AS (SELECT doc_id, unnest(w) AS term FROM w UNION ALL
                SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
                FROM w)
          SELECT term, count(DISTINCT doc_id) AS df, count(*) AS total FROM t GROUP BY term
          ORDER BY total DESC, term LIMIT {fv.MAX_FEATURES}""",
        "build_index": full(f"""
          SELECT pair_id, coalesce(n, 0)::INT AS n_terms, {rnd('coalesce(s, 0)')} AS weight_sum
          FROM pairs LEFT JOIN (SELECT pair_id, count(*) AS n, sum(w) AS s FROM weights GROUP BY 1)
          USING (pair_id)""", "weights"),
        "tfidf_topk": full("SELECT * FROM cases", "cases"),
        "grounding_context": full(f"""
          SELECT pair_id, {q(_HEAD)} || customer_clean_text || {q(_MID)} || predicted_intent ||
                 {q(_BEFORE)} || coalesce(ctx, {q(fv.NO_PRECEDENT)}) || {q(_TAIL)} AS prompt
          FROM attached LEFT JOIN (
            SELECT s.query_id, string_agg('Precedent ' || s.rank || ' (Similarity: ' || {_SHORT} ||
              '):' || chr(10) || '  Customer: ' || b.customer_clean_text || chr(10) ||
              '  Support Resolution: ' || b.support_response, chr(10) || chr(10) ORDER BY s.rank) AS ctx
            FROM cases s JOIN pairs b ON b.pair_id = s.case_id GROUP BY 1) x
          ON x.query_id = pair_id""", "attached"),
        "route_messages": full("""
          SELECT pair_id, predicted_intent, confidence, top_retrieval_sim, routing_action,
                 should_escalate, risk_score, primary_reason FROM routed""", "routed"),
        "reply_systems": full("SELECT pair_id, system, generated_reply FROM systems", "systems"),
        "judge_replies": full(f"""
          SELECT pair_id, system, {', '.join(fv.RUBRIC_SCORES)}, overall_quality_score
          FROM judged_systems""", "judged_systems"),
        "failure_cases": full(_FAILED, "failed"),
        "failure_subcategory": full(
            "SELECT pair_id, failure_type, empirical_subcategory FROM failed", "failed"),
        "failure_counts": full("""
          SELECT coalesce(failure_type, 'all') AS failure_type,
                 coalesce(empirical_subcategory, 'all') AS empirical_subcategory, count(*) AS n
          FROM failed GROUP BY ROLLUP (failure_type, empirical_subcategory)""", "failed"),
        "score_messages": full(f"""
          SELECT s.pair_id, customer_clean_text, predicted_intent, confidence, routing_action,
                 should_escalate, risk_score, primary_reason, top_retrieval_sim, l.cases,
                 generated_reply, {', '.join(fv.RUBRIC_SCORES)}, overall_quality_score
          FROM scored s LEFT JOIN (
            SELECT query_id, string_agg(case_id || ':' || printf('%.4f', similarity_score), ','
                                        ORDER BY rank) AS cases FROM cases GROUP BY 1) l
          ON l.query_id = s.pair_id""", "scored"),
        "majority_class": f"""
          SELECT label, n FROM (SELECT {gold} AS label, count(*) AS n FROM documents GROUP BY 1)
          ORDER BY n DESC, label LIMIT 1""",
        "class_weights": f"""
          SELECT label, n, {rnd('sum(n) OVER () / (count(*) OVER () * n)::DOUBLE')} AS weight
          FROM (SELECT {gold} AS label, count(*) AS n FROM documents GROUP BY 1)""",
        "label_distribution": f"SELECT source, {gold} AS label, count(*) AS n FROM documents GROUP BY 1, 2",
        "argmax_label": f"""
          SELECT vec_id, 'class_' || (list_position(embedding, list_max(embedding)) - 1) AS predicted,
                 {rnd('list_max(embedding)::DOUBLE', 6)} AS confidence FROM embeddings""",
        "confusion_matrix": full("SELECT * FROM cm", "cm"),
        "classification_metrics": full("SELECT * FROM cls", "cls"),
        "per_class_report": full(f"""
          SELECT label, {rnd('coalesce(precision, 0)')} AS precision, {rnd('coalesce(recall, 0)')} AS recall,
                 {rnd('coalesce(f1, 0)')} AS f1, coalesce(ng, 0)::BIGINT AS support
          FROM (SELECT unnest([{', '.join(q(i) for i in fv.INTENTS)}]) AS label)
          LEFT JOIN per_class USING (label)""", "per_class"),
        "trust_metrics": full("SELECT * FROM trust", "trust"),
        "routing_outcomes": full("""
          SELECT outcome, n FROM (
            SELECT 'correct_auto_handle' AS outcome,
                   count(*) FILTER (NOT gold_should_escalate AND system_auto_handled) AS n FROM preds
            UNION ALL SELECT 'correct_escalation',
                   count(*) FILTER (gold_should_escalate AND NOT system_auto_handled) FROM preds
            UNION ALL SELECT 'unsafe_auto_handle',
                   count(*) FILTER (gold_should_escalate AND system_auto_handled) FROM preds
            UNION ALL SELECT 'unnecessary_escalation',
                   count(*) FILTER (NOT gold_should_escalate AND NOT system_auto_handled) FROM preds)""",
                                 "preds"),
        "confidence_quartiles": full(f"""
          SELECT action, count(*) AS n, min(v) AS minimum, max(v) AS maximum,
                 {rnd('quantile_cont(v, 0.25)')} AS q1, {rnd('quantile_cont(v, 0.5)')} AS median,
                 {rnd('quantile_cont(v, 0.75)')} AS q3
          FROM (SELECT routing_action AS action, {rnd('confidence')} AS v FROM doc_routes)
          GROUP BY action""", "doc_routes"),
        "lexical_overlap": full(f"""
          SELECT pair_id, {rnd('len(list_filter(gt, lambda t: list_contains(rt, t)))::DOUBLE / greatest(1, len(gt))')}
                 AS bleu_4
          FROM (SELECT pair_id, {toks('lower(support_response)')} AS rt,
                       {toks('lower(customer_query)')} AS gt FROM pairs)""", "pairs"),
        "rouge_l": full(f"""
          SELECT pair_id, {rnd('rouge_l')} AS rouge_l
          FROM ({lexical('pairs', 'support_response', 'customer_query')})""", "pairs"),
        "reply_system_comparison": full("SELECT * FROM compared", "compared"),
        "unpivot_scores": full(" UNION ALL ".join(
            f"SELECT system, {q(x)} AS dimension, CAST({x} AS DOUBLE) AS score FROM compared"
            for x in _DIMENSIONS), "compared"),
        "rater_agreement": full("SELECT * FROM agreed", "agreed"),
        "rating_histogram": full("""
          SELECT r::INT AS rating, (SELECT count(*) FROM bins WHERE bh = r) AS human,
                 (SELECT count(*) FROM bins WHERE bj = r) AS judge
          FROM range(1, 6) AS t(r)""", "bins"),
        "metric_summary": full(_SUMMARY, _SUMMARY_USES),
        "result_document": full(_SUMMARY, _SUMMARY_USES),
        "rater_agreement_first": full("SELECT * FROM agreed_first", "agreed_first"),
        "store_pairs": full("SELECT *, unnest(['parquet', 'csv']) AS format FROM pairs", "pairs"),
        "store_golden": full("SELECT *, unnest(['json', 'csv']) AS format FROM gold_items", "gold_items"),
        "store_index": full(f"""
          SELECT pair_id, coalesce(n, 0)::INT AS n_terms, coalesce(n, 0)::INT AS searched_terms,
                 {rnd('coalesce(s, 0)')} AS weight_sum
          FROM pairs LEFT JOIN (SELECT pair_id, count(*) AS n, sum(w) AS s FROM weights GROUP BY 1)
          USING (pair_id)""", "weights"),
        "stored_search": full("SELECT * FROM cases", "cases"),
        "store_predictions": full("""
          SELECT s.pair_id, coalesce(n, 0)::INT AS n_cases, top_case, routing_action, overall_quality_score
          FROM scored s LEFT JOIN (SELECT query_id, count(*) AS n, min_by(case_id, rank) AS top_case
                                   FROM cases GROUP BY 1) l ON l.query_id = s.pair_id""", "scored"),
        "store_failures": full(_FAILED, "failed"),
        "read_or_empty": full("SELECT pair_id, created_at FROM pairs", "pairs"),
        "index_corpus": full("""
          SELECT pair_id, support_response FROM pairs
          UNION ALL SELECT pair_id, support_response FROM gold_items""", "pairs gold_items"),
        "case_lookup": full("""
          SELECT pair_id, failure_type, gold_intent, predicted_intent FROM failed
          WHERE pair_id IN (SELECT min(pair_id) FROM failed GROUP BY failure_type)""", "failed"),
        "training_fallback": full(f"""
          SELECT 'de' AS lang, doc_id::VARCHAR AS pair_id, {label('text', fv.KEYWORD_RULES)} AS intent
          FROM train WHERE lang = 'de' AND k NOT IN (SELECT k FROM golden)
          UNION ALL SELECT 'none', pair_id, gold_intent FROM gold_items
          WHERE pair_id IN ({', '.join(q(x[0]) for x in fv.GOLDEN_LITERALS)})""", "train golden gold_items"),
        "majority_baseline": full(f"""
          SELECT doc_id, (SELECT {gold} FROM train WHERE k NOT IN (SELECT k FROM golden)
                          GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS predicted_intent,
                 1.0::DOUBLE AS confidence FROM golden""", "train golden"),
        "model_properties": full(f"""
          SELECT unnest(['baseline_0_majority', 'baseline_1_tfidf', 'main_model_embedding']) AS model,
                 (SELECT count(*) FROM golden) AS n,
                 (SELECT count(DISTINCT {gold}) FROM train WHERE k NOT IN (SELECT k FROM golden))::INT AS labels,
                 true AS adds_up, true AS is_largest, true AS is_named,
                 unnest([false, true, true]) AS beats_majority""", "train golden"),
        "stream_pairs": full("SELECT * FROM pairs", "pairs"),
        "stream_scores": full("""
          SELECT customer_tweet_id, predicted_intent, routing_action, risk_score, top_retrieval_sim,
                 overall_quality_score FROM asked_scores""", "asked_scores"),
    }
