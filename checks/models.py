"""Queries downstream of models, on the rule-based outputs, in SQL."""

from __future__ import annotations

import math

from checks.book import add, half_up, money_mean, money_total, units
from checks.reports import pct, union

CHECKS: dict[str, str] = {}
_LAST = "(select max(order_date) from silver_orders)"

# ---------------------------------------------------------------- churn
add("placed", """
select *, cast(('0x' || substr(md5(customer_id || '#42'), 1, 13)) as bigint) as place from feature_table""")
CHECKS["churn_split"] = """
select customer_id, churn_label, case when rn <= floor(0.7 * (n - 1)) + 1 then 'train' else 'test' end as split from (
  select *, row_number() over (partition by churn_label order by place) as rn, count(*) over (partition by churn_label) as n from placed)"""
_EFFECTS = [("total_spent", -0.0000004), ("avg_order_value", 0.00002), ("refund_count", 0.05), ("refund_rate", 2.5), ("abandon_rate", 1.5),
            ("avg_pages_viewed", -0.06), ("avg_session_duration", -0.000001), ("session_count", -0.04), ("pct_organic", 0.3),
            ("pct_social", -0.2), ("avg_rating", -0.35), ("payment_idx", 0.08)]
add("effects", union(
    f"select customer_id, {i} as no, '{f}' as feature, cast({f} as double) as value, {w:.10f}::double * (cast({f} as double) - "
    f"(select avg(cast({f} as double)) from feature_table)) as delta from feature_table" for i, (f, w) in enumerate(_EFFECTS)))
CHECKS["churn_linear_effects"] = "select customer_id, feature, value, round(delta, 6) as delta from effects"
add("rule_predictions", f"""
select customer_id, p as churn_probability, feature as top_churn_reason,
  case when p <= 0.25 then 'Low' when p <= 0.5 then 'Medium' when p <= 0.75 then 'High' else 'Critical' end as churn_risk_band,
  {_LAST} as scored_date
from (select customer_id, recency_days / (cast(recency_days as double) + 40.0) as p from feature_table) join (
  select customer_id, feature from (select *, row_number() over (partition by customer_id order by abs(delta) desc, no) as rn from effects)
  where rn = 1) using (customer_id)""")
CHECKS["churn_predictions"] = "select * from rule_predictions"


def _auc(score: str) -> str:
    return (f"select '{score}' as score, round((sum(case when churn_label = 1 then r else 0 end) - n1 * (n1 + 1) / 2.0) / (n1 * n0), 6) as auc "
            f"from (select churn_label, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0 as r, "
            f"count(*) filter (churn_label = 1) over () as n1, count(*) filter (churn_label = 0) over () as n0 from "
            f"(select churn_label, cast({score} as double) as s from feature_table join rule_predictions using (customer_id))) group by n1, n0")


CHECKS["churn_auc"] = union([_auc("churn_probability"), _auc("avg_rating")])

# ---------------------------------------------------------------- segments
CHECKS["segment_clip"] = """
select customer_id, least(total_spent, (select quantile_cont(total_spent, 0.99) from feature_table)) as total_spent from feature_table"""
_POWERS = [("recency_days", "recency_scaled", 0.3, 6.0, 3.0), ("total_orders", "orders_scaled", 0.7, 14.0, 4.0),
           ("total_spent", "spent_scaled", 0.5, 2400.0, 500.0)]
_CENTERS = {0: (0.2, 0.0, 0.0), 1: (0.0, 0.9, 1.0), 2: (0.6, -1.1, -1.1)}


def _z(c, lam, mean, std):
    x = f"cast({c} as double)"
    return (f"((case when {x} >= 0 then (pow({x} + 1, {lam}) - 1) / {lam} else -((pow(1 - {x}, {2 - lam}) - 1) / {2 - lam}) end) - {mean}) / {std}")


def _back(z, lam, mean, std):
    y = f"({z} * {std} + {mean})"
    return f"case when {y} >= 0 then pow({y} * {lam} + 1, 1 / {lam}::double) - 1 else -(pow(-{y} * {2 - lam} + 1, 1 / {2 - lam}::double) - 1) end"


def _dist(center):
    return " + ".join(f"({s} - {v}::double) * ({s} - {v}::double)" for (_, s, *_r), v in zip(_POWERS, center))


_D = [f"({_dist(c)})" for c in _CENTERS.values()]
add("scaled", "select customer_id, recency_days, total_orders, total_spent, "
    + ", ".join(f"{_z(c, *p)} as {s}" for c, s, *p in _POWERS) + " from feature_table")
add("assigned", f"""
select *, case when {_D[0]} <= {_D[1]} and {_D[0]} <= {_D[2]} then 0 when {_D[1]} <= {_D[2]} then 1 else 2 end as cluster_id from scaled""")
CHECKS["segment_scaled"] = ("select customer_id, " + ", ".join(f"round({s}, 6) as {s}, round({_back(s, *p)}, 4) as {c}_back" for c, s, *p in _POWERS)
                            + " from scaled")
_VAR = " + ".join(f"var_pop({s})" for _, s, *_p in _POWERS)
CHECKS["segment_scores"] = f"""
select k, round(w, 4) as inertia, round(((t - w) / (k - 1)) / (w / (n - k)), 4) as calinski_harabasz from
  (select sum(v) as w, count(*) as k from (select ({_VAR}) * count(*) as v from assigned group by cluster_id)),
  (select ({_VAR}) * count(*) as t, count(*) as n from assigned)"""
add("centers", "select cluster_id, count(*) as customers, " + ", ".join(
    f"{_back(f'avg({s})', *p)} as {c}" for c, s, *p in _POWERS) + " from assigned group by cluster_id")
add("names", """
select *, case row_number() over (order by total_spent desc, cluster_id) when 1 then 'Champions' when 2 then 'Loyal Customers' else 'At Risk' end as rfm_segment
from centers""")
CHECKS["segment_names"] = """
select cast(cluster_id as integer) as cluster_id, rfm_segment, customers, round(recency_days, 4) as recency_days, round(total_orders, 4) as total_orders,
  round(total_spent, 4) as total_spent from names"""
add("rule_segments", f"""
select a.customer_id, rfm_segment, cast(a.cluster_id as integer) as rfm_cluster_id, cast(a.recency_days as double) as recency_days, a.total_orders,
  a.total_spent, 'nearest_center' as algorithm_used, cast(null as double) as silhouette_score, churn_probability,
  case when rfm_segment = 'Champions' then (case when churn_probability >= 0.5 then 'Urgent' else 'High' end)
       when rfm_segment = 'Loyal Customers' then (case when churn_probability >= 0.5 then 'High' else 'Medium' end) else 'Low' end as retention_priority,
  {_LAST} as segmented_date
from assigned a join names n on a.cluster_id = n.cluster_id left join rule_predictions p on a.customer_id = p.customer_id""")
CHECKS["segment_table"] = "select * from rule_segments"
CHECKS["segment_priority_counts"] = "select rfm_segment, retention_priority, count(*) as customers from rule_segments group by 1, 2"

# ---------------------------------------------------------------- recommendations
CHECKS["recommend_interactions"] = "select * from interactions"
for _key, _name, _idx in (("customer_id", "user", "user_idx"), ("product_id", "item", "item_idx")):
    CHECKS[f"recommend_{_name}_ids"] = (f"select {_key}, cast(row_number() over (order by count(*) desc, {_key}) - 1 as integer) as {_idx} "
                                        f"from interactions group by {_key}")
add("split_day", """
select min(order_date) as cutoff from (select order_date, sum(n) over (order by order_date) as until, sum(n) over () as total
  from (select order_date, count(*) as n from interactions where order_date is not null group by order_date)) where until >= total * 0.7::double""")
add("holdout", "select * from interactions where order_date > (select cutoff from split_day)")
CHECKS["recommend_split"] = """
select *, case when order_date <= (select cutoff from split_day) then 'train' else 'test' end as split from interactions where order_date is not null"""
CHECKS["recommend_fallback"] = """
select customer_id, product_id, cast(rank as integer) as rank, 0.0::double as als_score, 'popularity_fallback' as rec_source from
  (select customer_id from silver_orders where customer_id is not null group by customer_id having count(order_id) < 3),
  (select product_id, row_number() over (order by n desc, product_id) as rank from (select product_id, count(order_id) as n from purchases
   group by product_id order by n desc, product_id limit 10))"""
add("rule_recs", """
select customer_id, product_id, cast(rn as integer) as rank, confidence / rn as als_score from (select *, row_number() over (
  partition by customer_id order by confidence desc, order_date desc nulls last, product_id) as rn from interactions) where rn <= 10""")
CHECKS["recommend_history_ranking"] = "select * from rule_recs"
_IDEAL = sum(1.0 / math.log2(r + 1) for r in range(1, 11))


def _evaluated(recs: str, rank: str) -> str:
    return f"""
select sum(hits) as hits, count(*) as users, round(avg(dcg / {_IDEAL!r}::double), 8) as ndcg, round(sum(hits) / cast(count(*) as double), 8) as hits_per_user,
  round(sum(hits) / (10.0::double * count(*)), 8) as precision from (
  select r.customer_id, count(h.product_id) as hits, coalesce(sum(case when h.product_id is not null then 1.0::double / log2({rank} + 1) end), 0) as dcg
  from {recs} r left join holdout h on r.customer_id = h.customer_id and r.product_id = h.product_id group by r.customer_id)"""


CHECKS["recommend_evaluation"] = f"""
select cast(hits as bigint) as hits, users, ndcg, hits_per_user, precision, round(10.0::double / catalogue, 8) as random_baseline,
  round(cast(hits as double) / users / (10.0::double / catalogue), 6) as lift
from ({_evaluated('rule_recs', 'rank')}), (select count(distinct product_id) as catalogue from interactions)"""
CHECKS["recommend_rank_inversions"] = """
select * from (select *, lag(als_score) over (partition by customer_id order by rank) as score_before from (
  select customer_id, product_id, rank, case when rank = 4 then als_score * 5 else als_score end as als_score from rule_recs))
where als_score > score_before"""
CHECKS["recommend_segment_samples"] = """
select segment, r.customer_id, product_id, rank, als_score from rule_recs r join (
  select rfm_segment as segment, max(customer_id) as customer_id from rule_segments group by rfm_segment) s on r.customer_id = s.customer_id where rank <= 3"""

def _factors(key: str, index: str, scaled: bool) -> str:
    def byte(mark):
        return f"cast('0x' || substr(md5({key} || '#{mark}'), 1, 2) as integer)"
    size = f"pow(2, {byte('n')} // 32)" if scaled else "1"
    return f"select {index} as id, [" + ", ".join(f"({byte(i)} - 128) * {size}::double" for i in range(8)) + f"] as f from ({CHECKS[f'recommend_{index[:4]}_ids']})"


add("user_factors", _factors("customer_id", "user_idx", False))
add("item_factors", _factors("product_id", "item_idx", True))
CHECKS["recommend_best_items"] = """
select cast(u as bigint) as user, cast(i as bigint) as item, cast(rn as integer) as rank, score from (
  select u.id as u, i.id as i, list_dot_product(u.f, i.f) as score, row_number() over (partition by u.id order by list_dot_product(u.f, i.f) desc, i.id) as rn
  from user_factors u join item_factors i on true) where rn <= 10"""

# ---------------------------------------------------------------- re-ranking
add("baskets", f"""
select customer_id, {money_mean('items')} as avg_qty_per_order, count(session_id) as session_count from (
  select customer_id, session_id, sum(quantity) as items from silver_cart_events
  where action = 'cart_add' and customer_id is not null and quantity > 0 group by customer_id, session_id) group by customer_id""")
CHECKS["rerank_basket_size"] = "select * from baskets"
CHECKS["rerank_basket_summary"] = f"""
select min(avg_qty_per_order) as min_q, max(avg_qty_per_order) as max_q, {money_mean('avg_qty_per_order', 6)} as mean_q,
  round(quantile_cont(avg_qty_per_order, 0.25), 6) as p25_q, round(quantile_cont(avg_qty_per_order, 0.5), 6) as median_q,
  round(quantile_cont(avg_qty_per_order, 0.75), 6) as p75_q from baskets"""
add("rfmq", """
select s.*, coalesce(avg_qty_per_order, (select quantile_cont(avg_qty_per_order, 0.5) from baskets)) as avg_qty_per_order
from rule_segments s left join baskets b on s.customer_id = b.customer_id""")
CHECKS["rerank_basket_filled"] = "select customer_id, rfm_segment, avg_qty_per_order from rfmq"
CHECKS["rerank_segment_baskets"] = f"select rfm_segment, {money_mean('avg_qty_per_order')} as avg_q from rfmq group by rfm_segment"
_DIMS = [("recency_days", "R", -1), ("total_orders", "F", 1), ("total_spent", "M", 1), ("avg_qty_per_order", "Q", 1)]
add("zscores", "select *, " + ", ".join(
    f"({c} - (select avg({c}) from rfmq)) / (select stddev_pop({c}) from rfmq) * {s} as {d}_scaled" for c, d, s in _DIMS) + " from rfmq")
CHECKS["rerank_standardised"] = "select customer_id, " + ", ".join(f"round({d}_scaled, 6) as {d}_scaled" for _, d, _s in _DIMS) + " from zscores"
_X = {d: f"({d}_scaled + abs((select min({d}_scaled) from zscores)) + 0.0001)" for _, d, _s in _DIMS}
add("shares", "select customer_id, " + ", ".join(f"{x} / (select sum({x}) from zscores) as p_{d}" for d, x in _X.items()) + " from zscores")
add("entropy", "select " + ", ".join(f"-sum(case when p_{d} > 0 then p_{d} * ln(p_{d}) else 0 end) / ln(count(*)) as e_{d}" for d in _X) + " from shares")
_SPREAD = " + ".join(f"(1 - e_{d})" for d in _X)
add("weights", "select *, " + ", ".join(f"(1 - e_{d}) / ({_SPREAD}) as w_{d}" for d in _X) + " from entropy")
CHECKS["rerank_entropy_weights"] = "select " + ", ".join(f"round({k}_{d}, 6) as {k}_{d}" for k in "ew" for d in _X) + " from weights"
add("rule_weighted", """
select *, (rfmq_raw_score - min(rfmq_raw_score) over ()) / (max(rfmq_raw_score) over () - min(rfmq_raw_score) over ()) + 0.5 as rfmq_weight from (
  select z.*, w_R * R_scaled + w_F * F_scaled + w_M * M_scaled + w_Q * Q_scaled as rfmq_raw_score from zscores z cross join weights)""")
CHECKS["rerank_multiplier"] = "select customer_id, round(rfmq_raw_score, 6) as rfmq_raw_score, round(rfmq_weight, 6) as rfmq_weight from rule_weighted"
CHECKS["rerank_multiplier_summary"] = union(
    f"select {c} as group_name, round(avg(rfmq_weight), 6) as mean_weight, round(min(rfmq_weight), 6) as min_weight, round(max(rfmq_weight), 6) as max_weight, "
    f"count(*) as customers, '{c}' as grouped_by from rule_weighted group by {c}" for c in ("rfm_segment", "retention_priority"))
CHECKS["rerank_multiplier_medians"] = union(
    f"select '{c}' as grouped_by, g as group_name, round(median(rfmq_weight), 6) as median_weight from (select unnest([{vals}]) as g) "
    f"left join rule_weighted on {c} = g group by g" for c, vals in (
        ("rfm_segment", "'Champions', 'Loyal Customers', 'At Risk'"), ("retention_priority", "'Urgent', 'High', 'Medium', 'Low'")))
add("matrix", """
select * from (values ('Champions', 'Urgent', 1.5), ('Champions', 'High', 1.3), ('Champions', 'Medium', 1.1), ('Champions', 'Low', 1.0),
  ('Loyal Customers', 'Urgent', 1.3), ('Loyal Customers', 'High', 1.2), ('Loyal Customers', 'Medium', 1.0), ('Loyal Customers', 'Low', 0.9),
  ('At Risk', 'Urgent', 1.1), ('At Risk', 'High', 1.0), ('At Risk', 'Medium', 0.9), ('At Risk', 'Low', 0.8)) as t(seg, pri, weight)""")
CHECKS["rerank_matrix_weights"] = """
select customer_id, cast(coalesce(weight, 1.0) as double) as rfmq_weight from rule_segments left join matrix on rfm_segment = seg and retention_priority = pri"""
CHECKS["rerank_matrix_coverage"] = """
select rfm_segment, retention_priority, count(*) as customers, cast(coalesce(max(weight), 1.0) as double) as rfmq_weight, max(weight) is not null as is_listed
from rule_segments left join matrix on rfm_segment = seg and retention_priority = pri group by 1, 2"""
add("rule_reranked", """
select *, cast(row_number() over (partition by customer_id order by rfmq_score desc, rank) as integer) as rfmq_rank from (
  select r.*, rfmq_weight, rfm_segment, retention_priority, churn_probability, als_score * rfmq_weight as rfmq_score
  from rule_recs r join rule_weighted w on r.customer_id = w.customer_id)""")
CHECKS["rerank_table"] = f"""
select customer_id, product_id, rfmq_rank, als_score, round(rfmq_weight, 6) as rfmq_weight, round(rfmq_score, 6) as rfmq_score, rfm_segment as segment,
  retention_priority, churn_probability, {_LAST} as scored_date from rule_reranked"""
CHECKS["rerank_summary"] = """
select rfm_segment as segment, retention_priority, count(*) as row_count, round(avg(rfmq_score), 6) as avg_rfmq_score,
  round(max(rfmq_score), 6) as max_rfmq_score, round(avg(rfmq_weight), 6) as avg_weight from rule_reranked group by 1, 2"""
add("both_rankings", f"select 'als' as ranking, * from ({_evaluated('rule_reranked', 'rank')}) union all select 'rfmq', * from ({_evaluated('rule_reranked', 'rfmq_rank')})")
CHECKS["rerank_lift"] = """
select ranking, cast(hits as bigint) as hits, users, ndcg, hits_per_user, precision,
  round((precision - bp) / nullif(bp, 0) * 100, 6) as precision_lift_pct, round((ndcg - bn) / nullif(bn, 0) * 100, 6) as ndcg_lift_pct
from both_rankings, (select precision as bp, ndcg as bn from both_rankings where ranking = 'als')"""

# ---------------------------------------------------------------- review insight
CHECKS["insight_text_coverage"] = f"""
select total, with_text, ghosts, total - with_text as rating_only, {pct('with_text', 'total', 1)} as text_pct from (select count(*) as total,
  count(*) filter (review_text is not null and review_text <> 'null') as with_text, count(*) filter (_is_ghost_order) as ghosts from silver_reviews)"""
add("scorable", """
select * from silver_reviews where review_text is not null and trim(review_text) <> '' and review_text <> 'null' and not _is_ghost_order""")
CHECKS["insight_scorable"] = "select * from scorable"
CHECKS["insight_unscored"] = "select review_id, review_date from scorable where review_date >= date '2024-07-01'"
_POS = "great good love excellent perfectly happy recommend fast".split()
_NEG = "terrible late broken disappointed poor rude unhelpful wrong bad refund cheap".split()
_ISSUES = [("slow delivery", "late delay delayed slow"), ("damaged product", "broken damaged cracked"), ("poor quality", "poor cheap"),
           ("unhelpful customer support", "rude unhelpful"), ("wrong item", "wrong"), ("refund request", "refund")]


def _list(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


add("hits", f"""
select review_id, len(list_filter(w, lambda x: list_contains({_list(_POS)}, x))) as good, len(list_filter(w, lambda x: list_contains({_list(_NEG)}, x))) as bad,
  list_filter([{', '.join(f"case when list_has_any(w, {_list(t.split())}) then '{i}' end" for i, t in _ISSUES)}], lambda x: x is not null) as found
from (select review_id, regexp_split_to_array(translate(review_text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z]+') as w from scorable)""")
add("replies", f"""
select review_id, case when good > bad then 'positive' when bad > good then 'negative' else 'neutral' end as sentiment,
  {half_up('greatest(good + bad, 1) + abs(good - bad)', '2 * greatest(good + bad, 1)', 2)} as sentiment_score,
  '[' || array_to_string(list_transform(found, lambda x: '"' || x || '"'), ',') || ']' as issues from hits""")
CHECKS["insight_scores"] = """
select review_id, '{"sentiment":"' || sentiment || '","score":' || sentiment_score || ',"issues":' || issues || '}' as sentiment_raw from replies"""
add("scored", f"""
select r.review_id, customer_id, product_id, order_id, rating, review_text, review_date, sentiment, sentiment_score,
  cast(case sentiment when 'positive' then 1 when 'neutral' then 0 when 'negative' then -1 end as integer) as sentiment_label, issues, {_LAST} as scored_date
from scorable r join replies p on r.review_id = p.review_id""")
CHECKS["insight_parsed"] = "select * exclude (review_text) from scored"
# the words that carry sentiment, each language on a line of its own: kept here once more, apart from the operator
_KINDS = {
    "stop": ". ! ? ;",
    "praise": """good great excellent wonderful superb reliable comfortable delighted sturdy pleasant beautiful perfect helpful satisfied
      gut gute toll ausgezeichnet wunderbar zuverlässig bequem schön perfekt hilfreich zufrieden
      bon bonne excellente merveilleux fiable confortable agréable parfait utile satisfait
      bueno buena excelente maravilloso cómodo agradable perfecto útil satisfecho""",
    "blame": """bad awful horrible useless flimsy faulty defective annoying disappointing ugly worst unacceptable stupid damaged
      schlecht schlechte furchtbar schrecklich nutzlos defekt kaputt ärgerlich enttäuschend hässlich mangelhaft
      mauvais mauvaise affreux inutile défectueux cassé décevant laid pénible
      malo mala terrible inútil defectuoso roto decepcionante feo pésimo""",
    "negation": "not no never nothing neither cannot hardly nicht kein keine nie niemals pas jamais rien aucun nunca nada tampoco",
    "strong": "very really extremely absolutely totally sehr wirklich äußerst absolut très vraiment extrêmement muy realmente sumamente",
    "weak": "slightly somewhat fairly rather etwas ziemlich peu assez algo bastante",
    "contrast": "but however although aber jedoch obwohl mais cependant pourtant pero aunque sino",
}


def _fold(key: str, text: str, table: str, where: str = "true") -> str:
    """Places instead of a running state: for every word of praise or blame the last negation, contrast and hit before it, in its sentence."""
    kind = " ".join(f"when list_contains({_list(ws.split())}, w) then '{k}'" for k, ws in _KINDS.items())
    within = "(partition by k, s order by i"
    return rf"""
with listed as (select {key} as k, regexp_extract_all(lower(coalesce({text}, '')), '\p{{L}}+|[.!?;\n]') as ws from {table} where {where}),
words as (select k, unnest(ws) as w, unnest(range(len(ws))) as i from listed),
kinds as (select k, i, case when w = chr(10) then 'stop' {kind} end as kind from words),
sentences as (select *, count(*) filter (kind = 'stop') over (partition by k order by i) as s from kinds),
spots as (select *, lag(kind) over {within}) as degree, max(i) filter (kind = 'contrast') over (partition by k, s) as turn,
  max(i) filter (kind = 'negation') over {within} rows between unbounded preceding and 1 preceding) as negated,
  max(i) filter (kind in ('praise', 'blame', 'contrast')) over {within} rows between unbounded preceding and 1 preceding) as fresh from sentences),
valued as (select k, s, coalesce(i < turn, false) as earlier, case kind when 'praise' then 1 else -1 end
  * case degree when 'strong' then 3 when 'weak' then 1 else 2 end
  * case when i - negated <= 4 and negated > coalesce(fresh, -1) then -1 else 2 end as v from spots where kind in ('praise', 'blame')),
halves as (select k, s, coalesce(sum(v) filter (earlier), 0) as a, coalesce(sum(v) filter (not earlier), 0) as b, count(*) as n from valued group by k, s),
totals as (select k, sum(case when a <> 0 then a + 2 * b else b end) as t, sum(n) as n from halves group by k)
select l.k as {key}, cast(coalesce(t, 0) as integer) as balance, cast(coalesce(n, 0) as integer) as hits,
  case when t > 0 then 'positive' when t < 0 then 'negative' else 'neutral' end as sentiment from listed l left join totals on l.k = totals.k"""


CHECKS["insight_folded_documents"] = f"select * from ({_fold('doc_id', 'text', 'documents')})"
CHECKS["insight_folded_reviews"] = f"select * from ({_fold('review_id', 'review_text', 'scorable')})"
CHECKS["insight_parse_failures"] = """
select count(*) filter (not cut) as parsed, count(*) filter (cut) as failed from (select coalesce(helpful_votes % 7 = 0, false) as cut from scorable)"""
add("rule_insights", """
select s.*, churn_probability, churn_risk_band, top_churn_reason, rfm_segment, retention_priority from scored s
left join (select customer_id, churn_probability, churn_risk_band, top_churn_reason from rule_predictions) p on s.customer_id = p.customer_id
left join (select customer_id, rfm_segment, retention_priority from rule_segments) g on s.customer_id = g.customer_id""")
CHECKS["insight_table"] = "select * from rule_insights"
CHECKS["insight_distribution"] = f"select sentiment, count(*) as n, {money_mean('sentiment_score', 3)} as avg_score from rule_insights group by sentiment"
CHECKS["insight_hidden_dissatisfaction"] = f"""
select hidden, total, {pct('hidden', 'total', 1)} as hidden_pct from (select count(*) filter (rating >= 4 and sentiment = 'negative') as hidden,
  count(*) as total from rule_insights)"""
CHECKS["insight_urgent_negative"] = "select * from rule_insights where retention_priority = 'Urgent' and sentiment = 'negative'"
CHECKS["insight_by_risk_band"] = "select churn_risk_band, sentiment, count(*) as n from rule_insights group by 1, 2"
CHECKS["insight_complaints"] = "select issue, count(*) as reviews from (select unnest(found) as issue from hits) group by issue"
CHECKS["insight_with_complaint"] = "select review_id, customer_id, issues from rule_insights where contains(issues, '\"slow delivery\"')"

# ---------------------------------------------------------------- reports
add("complaint", """
select customer_id, review_id, issues from (select *, row_number() over (partition by customer_id order by review_date desc nulls last, review_id desc) as rn
  from rule_insights where sentiment = 'negative' and issues <> '[]') where rn = 1""")
add("watched", """
select p.customer_id, p.churn_probability, churn_risk_band, top_churn_reason, rfm_segment, retention_priority, total_spent, issues
from rule_predictions p left join rule_segments s on p.customer_id = s.customer_id left join complaint c on p.customer_id = c.customer_id""")
CHECKS["report_funnel"] = """
select count(*) as scored, count(*) filter (churn_risk_band = 'Critical') as critical, count(*) filter (retention_priority = 'Urgent') as urgent_champions,
  count(*) filter (retention_priority = 'Urgent' and issues is not null) as call_ready from watched"""
add("calls", """
select w.customer_id, rfm_segment, churn_probability, churn_risk_band, top_churn_reason, issues, total_spent, offers from watched w left join (
  select customer_id, string_agg(product_id, ', ' order by rfmq_rank) as offers from rule_reranked where rfmq_rank <= 3 group by customer_id) o
  on w.customer_id = o.customer_id where retention_priority = 'Urgent' and issues is not null""")
CHECKS["report_call_list"] = "select * from calls"
CHECKS["report_value_at_risk"] = f"""
select customers, coalesce(spend, 0.0) as spend_at_risk, cast(ceil(customers * 0.25) as bigint) as recovered_customers,
  coalesce({half_up(f"{units('spend')} * 25", '1000000', 2)}, 0.0) as recovered_spend
from (select count(*) as customers, {money_total('total_spent')} as spend from calls)"""
CHECKS["report_heat_map"] = "select rfm_segment, " + ", ".join(
    f"count(*) filter (retention_priority = '{p}') as \"{p}\"" for p in ("Urgent", "High", "Medium", "Low")) + " from rule_segments group by rfm_segment"
CHECKS["report_reasons_by_band"] = "select churn_risk_band, top_churn_reason, count(*) as customers from rule_predictions group by 1, 2"

# ---------------------------------------------------------------- what must hold for the fitted models
CHECKS["audit_churn_predictions"] = "select customer_id, true as in_range, true as probability_follows, true as band_follows, true as reason_follows from feature_table"
CHECKS["audit_churn_logistic"] = f"""
select 'logistic_regression' as model, count(*) as train_rows, true as stationary from ({CHECKS['churn_split']}) where split = 'train'"""
_TREES = [("random_forest", 100), ("boosted_trees", 300)]
CHECKS["audit_churn_trees"] = union(f"select '{m}' as model, customer_id, true as follows from feature_table" for m, _ in _TREES)
CHECKS["churn_rules"] = union(f"select '{m}' as model, {n} as trees, count(*) as customers, true as one_leaf_per_tree from feature_table" for m, n in _TREES)
CHECKS["audit_churn_comparison"] = f"""
select model, test_rows, true as auc_follows, true as best_follows from (values ('logistic_regression'), ('random_forest'), ('boosted_trees')) as m(model),
  (select count(*) as test_rows from ({CHECKS['churn_split']}) where split = 'test')"""
CHECKS["audit_churn_importance"] = """
select feature, count(*) as customers, true as effects_follow, true as importance_follows from effects group by feature"""
CHECKS["audit_segment_powers"] = union(
    f"select '{c}' as feature, count({c}) as customers, false as improvable, true as standardised from feature_table" for c, *_p in _POWERS)
CHECKS["audit_segments"] = "select customer_id, true as nearest, true as name_follows, true as priority_follows from feature_table"
add("trained", "select distinct customer_id, product_id from interactions where order_date <= (select cutoff from split_day)")
CHECKS["audit_best_items"] = """
select customer_id, (select least(10, count(distinct product_id)) from trained) as offers, true as scores_follow, true as none_better
from (select distinct customer_id from trained)"""
CHECKS["audit_recommendations"] = """
select customer_id, 'als' as rec_source, (select least(10, count(distinct product_id)) from trained) as offers, cast(1 as bigint) as first_ranks, cast(0 as bigint) as inversions
from (select distinct customer_id from trained)
union all
select customer_id, 'popularity_fallback', (select least(10, count(distinct product_id)) from purchases), 1, 0
from (select customer_id from silver_orders where customer_id is not null group by customer_id having count(order_id) < 3)
where customer_id not in (select customer_id from trained)"""
