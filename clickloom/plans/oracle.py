"""SQL views shared by the oracle queries, in the dialect of the checking engine.

`with_views` puts in front of a query the views it mentions, directly or through
another view, in the order given here.
"""

from __future__ import annotations

import re

_SPLITS = {"train": (5, 5, 7), "validation": (8, 8, 8), "test": (9, 9, 9)}

VIEWS: dict[str, str] = {
    "ev": """select event_id, user_id, event_type, value, ts,
  cast(json_extract_string(props,'$.k') as bigint) article_id,
  epoch_us(ts)/1000000.0 t,
  cast(floor((epoch_us(ts)/1000000.0-1704067200.0)/259200.0) as int) b
from events""",
    "articles": """select d.doc_id article_id,
  case when d.lang='es' then null else d.lang end category_str,
  split_part(d.text,chr(10),1) title,
  case when d.doc_id%7=0 then null else d.source end subtitle,
  d.text body, a.views total_pageviews, a.inviews total_inviews, a.rt total_read_time,
  cast(l.quality as double) sentiment_score,
  cast(1704067200-(d.doc_id%20)*86400 as double) published
from documents d
left join (select article_id, nullif(sum(case when event_type='view' then 1 else 0 end),0) views,
             count(*) inviews, sum(value) rt from ev group by article_id) a on a.article_id=d.doc_id
left join labels l on l.doc_id=d.doc_id
@known@""",
    "art_idx": "select article_id, row_number() over (order by article_id) idx "
    "from (select distinct article_id from articles)",
    "user_idx": "select user_id, row_number() over (order by user_id)-1 idx "
    "from (select distinct user_id from ev where b between 5 and 9)",
    "cat_code": "select category_str, row_number() over (order by category_str) code "
    "from (select distinct category_str from articles where category_str is not null)",
    "cat_dict": "select category_str, row_number() over (order by category_str)-1 cat_id "
    "from (select coalesce(category_str,'UNK') category_str from articles union select 'UNK')",
    "feats": """select a.article_id, coalesce(i.idx,0) id_encoded, coalesce(c.code,0) cat_encoded,
  ln(1+coalesce(total_pageviews,0)) norm_views, ln(1+coalesce(total_inviews,0)) norm_inviews,
  coalesce(sentiment_score,0) sentiment_score, ln(1+coalesce(total_read_time,0)) norm_read_time,
  published published_time
from articles a left join art_idx i using (article_id) left join cat_code c using (category_str)""",
    "vec": "select vec_id article_id, cast(embedding as double[]) v from embeddings",
    "vecn": "select article_id, list_transform(v, lambda x: x/(sqrt(list_dot_product(v,v))+1e-4)) v from vec",
    "vecl": "select article_id, unnest(v) x, generate_subscripts(v,1) d from vec",
    "vecnl": "select article_id, unnest(v) x, generate_subscripts(v,1) d from vecn",
}

for _s, (_c, _lo, _hi) in _SPLITS.items():
    VIEWS[f"hist_{_s}"] = f"""select user_id, event_id, article_id, ts, t,
  least(value,100.0) scroll_percentage,
  case when event_type='error' then null else value*4-10 end read_time,
  least(value,100.0)/100.0 scroll,
  case when event_type='error' then 0 else value*4-10 end clean_time,
  ln(1+greatest(case when event_type='error' then 0 else value*4-10 end,0)) log_time
from ev where b<{_c} @cold@"""
    VIEWS[f"bl_{_s}"] = f"""select min(fe) over (partition by user_id,b) impression_id, user_id, b,
  min(ft) over (partition by user_id,b) imp_t, article_id, clicked,
  row_number() over (partition by user_id,b order by fe)-1 pos
from (select user_id, b, article_id, min(event_id) fe, min(t) ft,
        max(case when event_type='click' then 1 else 0 end) clicked
      from ev where b>={_lo} and b<={_hi} group by user_id,b,article_id) x"""
    VIEWS[f"imp_{_s}"] = f"""select impression_id, user_id, imp_t, count(*) n_inview, sum(clicked) n_clicked,
  case when user_id%11=0 then null else user_id%3 end device_type,
  case when user_id%5=0 then 20+user_id%60 end age,
  case when user_id%7=0 then user_id%2 end gender,
  case when user_id%10=0 then 1 else 0 end is_subscriber,
  case when user_id%9=0 then null when user_id%4=0 then 1 else 0 end is_sso_user,
  impression_id session_id
from bl_{_s} group by impression_id, user_id, imp_t"""
    VIEWS[f"recent30_{_s}"] = f"""select *, row_number() over (partition by user_id order by t,event_id)-1 pos from (
  select *, row_number() over (partition by user_id order by t desc,event_id desc) age
  from hist_{_s}) where age<=30"""
    VIEWS[f"first50_{_s}"] = f"""select * from (
  select *, row_number() over (partition by user_id order by t,event_id)-1 pos from hist_{_s}) where pos<50"""
    VIEWS[f"fixed_{_s}"] = f"""select impression_id, user_id, pos, article_id, clicked label,
  ((37*article_id+11*impression_id)%100)/25.0-2 score from bl_{_s}"""
    # Similarity: mean of normalised known vectors over the last 30 reads.
    VIEWS[f"sim_user_{_s}"] = f"""select user_id, list(m order by d) p from (
  select h.user_id, v.d, avg(v.x) m from recent30_{_s} h join vecnl v using (article_id) group by 1,2) group by 1"""
    VIEWS[f"sim_{_s}"] = f"""select b.impression_id, b.user_id, b.pos, b.article_id, b.clicked label,
  coalesce(list_dot_product(u.p, v.v),0) score
from bl_{_s} b left join sim_user_{_s} u using (user_id) left join vecn v using (article_id)"""
    # Uniform profile: first 50 reads, unknown ones as zero vectors.
    VIEWS[f"uni_user_{_s}"] = f"""select user_id, list(m order by d) p from (
  select h.user_id, v.d, sum(v.x)/any_value(n.n) m from first50_{_s} h join vecl v using (article_id)
  join (select user_id, count(*) n from first50_{_s} group by 1) n on n.user_id=h.user_id group by 1,2) group by 1"""
    VIEWS[f"uni_{_s}"] = f"""select b.impression_id, b.user_id, b.pos, b.article_id, b.clicked label,
  coalesce(list_dot_product(u.p, v.v),0) score
from bl_{_s} b left join uni_user_{_s} u using (user_id) left join vec v using (article_id)"""
    # Quality profile: overall + high - sigmoid(0.5) * low.
    VIEWS[f"qual_user_{_s}"] = f"""select user_id, list(g+hi-(1/(1+exp(-0.5)))*lo order by d) p from (
  select h.user_id, v.d, avg(v.x) g,
    coalesce(avg(v.x) filter (h.hq), sum(v.x)/any_value(n.n)) hi,
    coalesce(avg(v.x) filter (h.lq), sum(v.x)/any_value(n.n)) lo
  from (select *, log_time>4.0 and scroll>0.2 hq,
          (log_time<1.3 or scroll<0.1) and not (log_time>4.0 and scroll>0.2) lq from recent30_{_s}) h
  join vecl v using (article_id)
  join (select user_id, count(*) n from recent30_{_s} group by 1) n on n.user_id=h.user_id
  group by 1,2) group by 1"""
    VIEWS[f"qual_{_s}"] = f"""select b.impression_id, b.user_id, b.pos, b.article_id, b.clicked label,
  coalesce(list_dot_product(u.p, v.v)/sqrt(len(v.v)),0) score
from bl_{_s} b left join qual_user_{_s} u using (user_id) left join vec v using (article_id)"""


def sample_sql(policy: str, rows: str) -> str:
    """One row per sample and candidate (pos 0 = positive) of a sampling policy over `rows`."""
    clicks = f"select impression_id, article_id positive from {rows} where clicked=1"
    one = f"""select impression_id, article_id positive from (select *, row_number() over
      (partition by impression_id order by {{key}}) rn from {rows} where clicked=1) where rn=1"""
    by_hash = one.format(key="md5('42|'||impression_id||'|'||article_id)")
    samples = {"per_click": clicks, "padded": by_hash, "cycled": by_hash, "padded_first": one.format(key="pos")}[policy]
    order = "b.pos" if policy == "padded_first" else "md5('42|'||s.impression_id||'|'||s.positive||'|'||b.article_id)"
    pad = policy.startswith("padded")
    draw = "('0x'||substr(md5('42|'||s.impression_id||'|'||s.positive||'|'||(i-1)),1,8))::bigint % n.n"
    short = {"per_click": draw, "cycled": "(i-1) % n.n"}.get(policy, "i-1")
    pools = f"""(select s.impression_id, s.positive, b.article_id, row_number() over
      (partition by s.impression_id, s.positive order by {order})-1 k
      from ({samples}) s join {rows} b on b.impression_id=s.impression_id and b.clicked=0)"""
    return f"""select s.impression_id, s.positive, i pos,
      (case when i=0 then s.positive else coalesce(p.article_id, {"0" if pad else "s.positive"}) end)::bigint article_id,
      (case when i=0 then 1 else 0 end)::bigint as label,
      (case when {str(pad).lower()} and i>coalesce(n.n,0) then 0 else 1 end)::bigint "valid"
    from ({samples}) s cross join range(5) r(i)
    left join (select impression_id, count(*) n from {rows} where clicked=0 group by 1) n on n.impression_id=s.impression_id
    left join {pools} p on p.impression_id=s.impression_id and p.positive=s.positive
      and p.k=case when coalesce(n.n,0)=0 then -1 when n.n>=4 then i-1 else {short} end"""


def _sim_sample(policy: str) -> str:
    return f"""select b.impression_id, b.pos, b.article_id, b.label, coalesce(list_dot_product(u.p, v.v),0) score
from ({sample_sql(policy, "bl_validation")}) b join imp_validation i using (impression_id)
left join sim_user_validation u on u.user_id=i.user_id left join vecn v on v.article_id=b.article_id
where b."valid"=1"""


VIEWS["simpad"] = _sim_sample("padded_first")
VIEWS["simcyc"] = _sim_sample("cycled")


def _metric_views(source: str) -> dict[str, str]:
    ranked = f"{source}_ranked"
    return {
        ranked: f"""select *, row_number() over (partition by impression_id order by score desc,pos) rk,
  rank() over (partition by impression_id order by score)
   + (count(*) over (partition by impression_id, score)-1)/2.0 avg_rank,
  max(score) over (partition by impression_id) top
from {source}""",
        f"{source}_per": f"""select impression_id, n, n_pos, coalesce(1.0/best,0) rr,
  coalesce(dcg5,0)/(1e-4+coalesce(list_sum(list_transform(range(1,least(n_pos,5)::bigint+1), lambda r: 1/log2(r+1))),0)) ndcg5,
  coalesce(dcg10,0)/(1e-4+coalesce(list_sum(list_transform(range(1,least(n_pos,10)::bigint+1), lambda r: 1/log2(r+1))),0)) ndcg10,
  case when n_pos>0 and n_pos<n then (rank_sum-n_pos*(n_pos+1)/2.0)/(n_pos*(n-n_pos)) end auc,
  bce_sum, case when n_pos=0 then 0 else lse-pos_shifted/n_pos end listnet
from (select impression_id, count(*) n, sum(label) n_pos, min(rk) filter (label=1) best,
  sum(1/log2(rk+1)) filter (label=1 and rk<=5) dcg5,
  sum(1/log2(rk+1)) filter (label=1 and rk<=10) dcg10,
  sum(avg_rank) filter (label=1) rank_sum,
  sum(greatest(score,0)-score*label+ln(1+exp(-abs(score)))) bce_sum,
  ln(sum(exp(score-top))) lse, sum((score-top)*label) pos_shifted
from {ranked} group by impression_id)""",
    }


VIEWS.update(_metric_views("simpad"))
VIEWS.update(_metric_views("simcyc"))
for _s in _SPLITS:
    for _model in ("fixed", "sim", "uni", "qual"):
        VIEWS.update(_metric_views(f"{_model}_{_s}"))


def with_views(sql: str, unknown_articles: bool = False, cold_users: bool = False) -> str:
    """Prefix `sql` with the views it needs, with the holdouts that the query asks for."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(VIEWS[name])
    parts = [f"{name} as ({VIEWS[name]})" for name in VIEWS if name in needed]
    text = ("with " + ",\n".join(parts) + "\n" if parts else "") + sql.strip()
    known = "where d.doc_id<95 or d.doc_id>=100" if unknown_articles else ""
    return text.replace("@known@", known).replace("@cold@", "and user_id%13<>0" if cold_users else "")
