"""SQL for fitted models: the penalised loss is convex and k-means starts are fixed, so SQL can repeat both fits.

Logistic regression is fitted again by accelerated gradient descent, in a recursive query over (label, feature) weights, until the weights
stand still to about nine digits; that is another way to the optimum than Spark's, so agreement shows that both are there.
"""

from __future__ import annotations

import math

from threadlens.functions.prompts import GENERIC_REPLY, REPLY_TEMPLATES
from threadlens.operators import models
from workload.oracles import CLASSIFIER, CTE, DISCOVERY, W, clean, f2, lit, re_, scores, tfidf, with_, with_tfidf

STEEPEST = 0.75   # above half the largest eigenvalue of the mean outer product of unit vectors with an intercept


def splits_of(source: str, key: str) -> str:
    """``source`` with the split of every row by its key."""
    return (f"select *, case when r<=floor(n*0.7e0) then 'train' when r<=floor(n*0.7e0)+floor(n*0.15e0) then 'validation' else 'test' end as split from ("
            f"select *, row_number() over (order by md5('42:'||{key}), {key}::varchar) as r, count(*) over () as n from {source})")


def fit(rows: str, name: str, n: str, c: float, rounds: int, n_guess: int) -> dict[str, tuple[str, list[str]]]:
    """Blocks ``name``_t (it, l, p, w, m): descent on ``rows`` (i, y, p, xv), whose feature -1 is the constant 1.

    ``n`` is SQL for the number of rows; ``n_guess`` about the same, for the momentum only.
    """
    lam = f"(1e0/({c}*{n}))"
    root = math.sqrt(STEEPEST * c * n_guess + 1)
    momentum = (root - 1) / (root + 1)
    step = f"(1e0/({STEEPEST}e0+{lam}))"
    return {
        f"{name}_s": (f"select y, {n}*1e0/((select count(distinct y) from {rows})*count(distinct i)) as s from {rows} group by y", [rows]),
        f"{name}_e": (f"select i, y, s, p, xv from {rows} join {name}_s using (y)", [f"{name}_s"]),
        f"{name}_t(it, l, p, w, m)": (
            f"select 0, l, p, 0e0, 0e0 from (select distinct y as l from {rows}), (select distinct p from {rows}) union all "
            f"select it+1, l, p, nw, nw+{momentum}*(nw-w) from (select any_value(t.it) as it, t.l, t.p, any_value(t.w) as w, any_value(t.m)-{step}*("
            f"sum((pr-case when e.y=t.l then 1 else 0 end)*s*xv)/{n}+case when t.p<0 then 0 else {lam}*any_value(t.m) end) as nw "
            f"from {name}_t t join (select l, i, exp(z)/sum(exp(z)) over (partition by i) as pr from (select t.l, e.i, sum(t.m*e.xv) as z "
            f"from {name}_t t join {name}_e e on e.p=t.p where t.it<{rounds} group by t.l, e.i)) g on g.l=t.l join {name}_e e on e.i=g.i and e.p=t.p "
            f"where t.it<{rounds} group by t.l, t.p)", [f"{name}_e"]),
        f"{name}_w": (f"select l, p, w from {name}_t where it={rounds}", [f"{name}_t(it, l, p, w, m)"]),
    }


def predictions(name: str, rows: str) -> tuple[str, list[str]]:
    """(i, prediction, confidence) of rows (i, p, xv)."""
    return (f"select i, arg_min(l, (-pr, l)) as prediction, max(pr) as confidence from (select i, l, exp(z-max(z) over (partition by i))/sum(exp(z)) over (partition by i)*exp(max(z) over (partition by i)) as pr "
            f"from (select i, l, sum(w*xv) as z from {rows} join {name}_w using (p) group by i, l)) group by i", [rows, f"{name}_w"])


VECTORS = {
    "vec": ("select vec_id as i, 'class_'||label as y, list_concat([1e0], list_transform(embedding, lambda x: x::double)) as v from embeddings", []),
    "vecsplit": (splits_of("vec", "i"), ["vec"]),
    "vecall": ("select i, y, split, unnest(range(len(v)))-1 as p, unnest(v) as xv from vecsplit", ["vecsplit"]),
    "vectrain": ("select i, y, p, xv from vecall where split='train'", ["vecall"]),
    **fit("vectrain", "vf", "(select count(*) from vecsplit where split='train')", 1.0, 330, 350),
}
VECTORS["vecpred"] = predictions("vf", "vecall")
VECTORS["vecrows"] = ("select split, y as y_true, prediction as y_pred from vecsplit join vecpred using (i)", ["vecsplit", "vecpred"])

GRADED = {
    "graded": ("select doc_id, case when quality=1 then 'good' else 'poor' end as y from documents join labels using (doc_id)", []),
    "gsplit": (splits_of("graded", "doc_id"), ["graded"]),
}


def text_features(train: str, everything: str = "documents") -> dict[str, tuple[str, list[str]]]:
    """Blocks of a vocabulary of the documents in ``train`` and the features of all documents in ``everything``."""
    return {
        "tcounts": (f"select * from counts where doc_id in (select doc_id from {train})", ["counts", train]),
        "tvocab": (f"select term, row_number() over (order by term)-1 as idx, ln((n+1e0)/(df+1e0))+1e0 as idf from (select term, count(*) as df, sum(tf) as cf, "
                   f"(select count(*) from {train}) as n from tcounts group by term) where df>=2 and df<=n*0.95e0 order by cf desc, term limit 10000", ["tcounts"]),
        "tnum": ("select term, row_number() over (order by term)-1 as idx, idf from tvocab", ["tvocab"]),
        "tall": ("select doc_id as i, idx as p, w/sqrt(sum(w*w) over (partition by doc_id)) as xv from (select doc_id, idx, (1e0+ln(tf))*idf as w from counts join tnum using (term)) "
                 f"union all select doc_id, -1, 1e0 from {everything}", ["tnum", "counts", *([everything] if everything != "documents" else [])]),
        "ttrain": (f"select i, y, p, xv from tall join {train} on doc_id=i", ["tall", train]),
    }


def in_blocks(blocks: dict, names: list[str], body: str, tf: bool = False) -> str:
    CTE.update(blocks)
    try:
        return with_tfidf(names, body, **CLASSIFIER) if tf else with_(names, body)
    finally:
        for k in blocks:
            CTE.pop(k)


BY_TEXT = GRADED | text_features("graded") | fit("ttrain", "tf", "(select count(*) from graded)", 1.0, 350, 400)
BY_TEXT["textpred"] = predictions("tf", "tall")
_TRAIN = {"gtrain": ("select doc_id, y from gsplit where split='train'", ["gsplit"])}
TUNED = GRADED | _TRAIN | text_features("gtrain")
for k, (c, rounds) in enumerate(((0.1, 120), (1.0, 250), (10.0, 400))):
    TUNED |= fit("ttrain", f"c{k}", "(select count(*) from gtrain)", c, rounds, 280)
    TUNED[f"p{k}"] = predictions(f"c{k}", "tall")
    TUNED[f"q{k}"] = (f"select y as y_true, prediction as y_pred, split from gsplit join p{k} on i=doc_id", ["gsplit", f"p{k}"])


def report(source: str, split: str) -> str:
    return f"(select avg(f1) from ({scores(source, where=f'''split='{split}' ''')}))"


TUNED["picked"] = ("select *, row_number() over (order by val_macro_f1 desc, c)=1 as best from (" + " union all ".join(
    f"select {c}e0 as c, {re_(report(f'q{k}', 'validation'), 4)} as val_macro_f1, (select avg(case when y_true=y_pred then 1e0 else 0e0 end) from q{k} where split='test') as ta, "
    f"{report(f'q{k}', 'test')} as tf from (select 1)" for k, c in enumerate((0.1, 1.0, 10.0))) + ")", ["q0", "q1", "q2"])
TUNE = f"select c, val_macro_f1, best, case when best then {re_('ta', 4)} end as test_accuracy, case when best then {re_('tf', 4)} end as test_macro_f1 from picked"

ROUNDS, RESTARTS, K = models.ROUNDS, models.RESTARTS, 8
CLUSTERS = {
    "kx": ("select doc_id as i, term as p, weight as v from weights", ["weights"]),
    "kd": ("select doc_id as i, coalesce(own, 0e0) as own from documents left join (select i, sum(v*v) as own from kx group by i) on i=doc_id", ["kx"]),
    "k0": (f"select r, rn-1 as c, i from (select r, doc_id as i, row_number() over (partition by r order by md5('42:'||r||':'||doc_id), doc_id) as rn "
           f"from documents, (select unnest(range({RESTARTS})) as r)) where rn<={K}", []),
    # a restart ends with the round that moves no weight of its centres by more than STILL
    "kt(it, r, c, p, v, still)": (
        "select 0, r, c, '', 0e0, false from k0 union all select 0, r, c, p, v, false from k0 join kx using (i) union all select * from ("
        f"with cur as (select * from kt where it<{ROUNDS} and not still), norm as (select any_value(it) as it, r, c, sum(v*v) as n2 from cur group by r, c), "
        "dots as (select kx.i, cur.r, cur.c, sum(kx.v*cur.v) as d from kx join cur using (p) group by kx.i, cur.r, cur.c), "
        "near as (select i, r, arg_min(c, (round(own-2e0*coalesce(d, 0e0)+n2, 9), c)) as c from (select kd.i, kd.own, norm.r, norm.c, norm.n2 from kd, norm) b left join dots using (i, r, c) group by i, r), "
        "sizes as (select r, c, count(*) as n from near group by r, c), "
        "moved as (select it+1 as it, r, c, '' as p, 0e0 as v from norm union all "
        "select any_value(norm.it)+1, near.r, near.c, kx.p, sum(kx.v)/any_value(sizes.n) from near join kx using (i) join sizes using (r, c) join norm using (r, c) group by near.r, near.c, kx.p union all "
        "select cur.it+1, cur.r, cur.c, cur.p, cur.v from cur anti join sizes using (r, c) where cur.p<>''), "
        f"steps as (select r, max(abs(coalesce(moved.v, 0e0)-coalesce(cur.v, 0e0)))<={models.STILL} as still from moved full join cur using (r, c, p) group by r) "
        "select it, r, c, p, v, still from moved join steps using (r))", ["kx", "kd", "k0"]),
    "kend": ("select it, r, c, p, v from kt semi join (select r, max(it) as it from kt group by r) using (r, it)", ["kt(it, r, c, p, v, still)"]),
    "knear": ("select i, r, arg_min(c, (d, c)) as c, greatest(0e0, min(d)) as d from (select b.i, b.r, b.c, round(own-2e0*coalesce(d, 0e0)+n2, 9) as d from (select kd.i, own, r, c, n2 from kd, "
              "(select r, c, sum(v*v) as n2 from kend group by r, c)) b left join (select kx.i, kend.r, kend.c, sum(kx.v*kend.v) as d from kx join kend using (p) group by kx.i, kend.r, kend.c) using (i, r, c)) group by i, r", ["kend"]),
    "kbest": ("select i as doc_id, c as cluster_id from knear where r=(select r from knear group by r order by round(sum(d), 9), r limit 1)", ["knear"]),
}


def clusters() -> str:
    CTE.update(CLUSTERS)
    try:
        return with_tfidf(["kbest"], f"""select cluster_id, size, {re_('size*100e0/(select count(*) from documents)', 1)} as pct, coalesce(top_terms, '') as top_terms
            from (select cluster_id, count(*) as size from kbest group by cluster_id) left join (select cluster_id, string_agg(term, ', ' order by rn) as top_terms from (
            select cluster_id, term, row_number() over (partition by cluster_id order by round(sum(weight), 9) desc, term) as rn from weights join kbest using (doc_id)
            group by cluster_id, term) where rn<=15 group by cluster_id) using (cluster_id)""", **DISCOVERY)
    finally:
        for k in CLUSTERS:
            CTE.pop(k)


MESSAGES = tfidf(**CLASSIFIER) | text_features("mtrain", "musable") | fit("ttrain", "mf", "(select count(*) from mtrain)", 1.0, 350, 400) | {
    "mrows": (f"select tweet_id, text, {clean('text')} as clean_message, x.embedding::double[] as v from uniq join embeddings x "
              "on x.vec_id=ingest_seq%(select count(*) from embeddings) where inbound", ["uniq"]),
    "musable": ("select tweet_id as doc_id from mrows where clean_message<>''", ["mrows"]),
    "toks": (f"select tweet_id as doc_id, regexp_extract_all(lower(clean_message), '[{W}]{{2,}}') as t from mrows where clean_message<>''", ["mrows"]),
    "mtrain": ("select tweet_id as doc_id, intent as y from splits where split='train'", ["splits"]),
    "mstore": ("select customer_tweet_id as store_id, brand_text, list_transform(v, lambda x: (x/sqrt(list_inner_product(v, v)))::float::double) as v from ("
               "select e.*, x.embedding::double[] as v from evidence e join uniq u on u.tweet_id=e.customer_tweet_id join embeddings x on x.vec_id=u.ingest_seq%(select count(*) from embeddings))",
               ["evidence", "uniq"]),
    "mtop": (f"select tweet_id, rn, brand_text, {re_('score', 4)} as similarity from (select *, row_number() over (partition by tweet_id order by score desc, store_id) as rn from ("
             "select tweet_id, store_id, brand_text, round(list_inner_product(q.v, s.v)/sqrt(list_inner_product(q.v, q.v)*list_inner_product(s.v, s.v)), 12) as score from mrows q, mstore s "
             "where clean_message<>'')) where rn<=5", ["mrows", "mstore"]),
    "mevidence": (f"select tweet_id, count(*) as n, {re_('avg(similarity)', 4)} as evidence_score, arg_min(coalesce(brand_text, ''), rn) as reply from mtop group by tweet_id", ["mtop"]),
}
MESSAGES["mpred"] = predictions("mf", "tall")
MESSAGES["mjoined"] = (f"select *, {re_('0.5e0*(1e0-confidence)+0.5e0*(1e0-evidence_score)', 4)} as risk from (select r.*, prediction as intent, confidence, coalesce(n, 0) as n, "
                       "coalesce(evidence_score, 0e0) as evidence_score, reply as best from mrows r join mpred on i=r.tweet_id left join mevidence using (tweet_id))", ["mrows", "mpred", "mevidence"])
MESSAGES["mgated"] = ("select *, case when intent in ('account_access','billing_payment') then 'high_risk_intent' when confidence<0.6e0 then 'low_confidence' "
                      "when n=0 then 'no_evidence' when evidence_score<0.3e0 then 'weak_evidence' when risk>0.5e0 then 'composite_risk' else 'none' end as gate_triggered from mjoined", ["mjoined"])
SCORED = f"""select tweet_id, 'AppleSupport' as brand, text as customer_message, clean_message, intent, {re_('confidence', 2)} as confidence, evidence_score,
    case when n>0 then best else case intent {' '.join(f"when '{k}' then {lit(v)}" for k, v in REPLY_TEMPLATES.items())} else {lit(GENERIC_REPLY)} end end as reply, n>0 as grounded, 'template' as backend,
    case when gate_triggered='none' then 'AUTO_HANDLE' else 'ESCALATE' end as decision, case gate_triggered
      when 'high_risk_intent' then concat('Intent ''', intent, ''' is high-risk (financial/security). Always requires human review.')
      when 'low_confidence' then concat('Classifier confidence ', {f2('confidence')}, ' < threshold 0.6. Intent prediction is uncertain.')
      when 'no_evidence' then 'No historical support examples retrieved. Cannot generate a grounded response.'
      when 'weak_evidence' then concat('Retrieval evidence score ', {f2('evidence_score')}, ' < threshold 0.3. Historical examples are not sufficiently similar.')
      when 'composite_risk' then concat('Composite risk score ', {f2('risk')}, ' > 0.5 (confidence=', {f2('confidence')}, ', evidence=', {f2('evidence_score')}, '). Combined uncertainty too high.')
      else concat('All gates passed: confidence=', {f2('confidence')}, ', evidence_score=', {f2('evidence_score')}, ', composite_risk=', {f2('risk')}, ', ', n, ' examples retrieved.') end as decision_reason,
    gate_triggered, {re_('risk', 2)} as composite_risk, 'tfidf_lr' as classifier_used from mgated
  union all select tweet_id, 'AppleSupport', text, clean_message, null, null, null, null, null, null, 'ESCALATE', 'Empty or unreadable message.', null, null, null from mrows where clean_message=''"""

CONF, ROUGH = re_("confidence", 3), re_("confidence", 2)
ORACLES = {
    "embedding_lr": in_blocks(VECTORS, ["vecrows"], f"""select split, label, {re_('p', 4)} as precision, {re_('r', 4)} as recall, {re_('f1', 4)} as f1,
        support::bigint as support from ({scores('vecrows', by='split')})"""),
    "predict_with_confidence": in_blocks(VECTORS, ["vecpred"], f"select i as vec_id, split, y as intent, prediction, {CONF} as confidence, "
                                         "(select count(distinct y) from vectrain)::int as n_classes from vecsplit join vecpred using (i)"),
    "tfidf_lr": in_blocks(BY_TEXT, ["textpred"], f"select i as doc_id, prediction, {ROUGH} as confidence from textpred", tf=True),
    "top_features": in_blocks(BY_TEXT, ["tf_w"], f"""select intent, rank, term, {re_('c', 3)} as coefficient from (select l as intent, term, round(w, 5) as c,
        row_number() over (partition by l order by round(w, 5) desc, term)::int as rank from tf_w join tnum on idx=p) where rank<=10""", tf=True),
    "save_model": in_blocks(BY_TEXT | VECTORS, ["textpred", "vecpred"], f"""select 'tfidf_lr' as kind, i as id, prediction, {ROUGH} as confidence from textpred
        union all select 'embedding_lr', i, prediction, {ROUGH} from vecpred""", tf=True),
    "tune_regularization": in_blocks(TUNED, ["picked"], TUNE, tf=True),
    "discover_intents": clusters(),
    "score_messages": in_blocks(MESSAGES, ["mgated"], SCORED),
    "score_stream": in_blocks(MESSAGES, ["mgated"], SCORED),
}
