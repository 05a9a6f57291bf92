"""DuckDB SQL for the registered queries (same column names, same rounding)."""

from __future__ import annotations

from threadlens.functions.prompts import GENERIC_REPLY, JUDGE_DIMENSIONS, REPLY_TEMPLATES, SYSTEM_RULES
from threadlens.functions.text import INTENT_RULES, INTENTS
from threadlens.operators import vector_index as vi
from workload import fixtures as fx

S = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}"
W = r"\p{L}\p{N}_"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def re_(x: str, n: int) -> str:
    """Round half to even on the decimal value."""
    return f"cast(round_even(cast({x} as decimal(38,12)), {n}) as double)"


def f2(x: str) -> str:
    return f"printf('%.2f', {re_(x, 2)})"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{S}]+|[{S}]+$', '', 'g')"


def clean(x: str) -> str:
    return (f"coalesce(trim(regexp_replace(regexp_replace(regexp_replace({x},'https?://[^{S}]+',' ','g'),"
            f"'@[{W}]+',' ','g'),'[{S}]+',' ','g')),'')")


def label(x: str) -> str:
    whens = " ".join(
        f"when regexp_matches({x}, {lit('(?i)(?:' + '|'.join(p.replace(chr(92) + 'd', r'\p{Nd}') for p in ps) + ')')}) then '{i}'"
        for i, ps in INTENT_RULES.items())
    return f"case {whens} else 'other' end"


def stamp(x: str = "created_at") -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


PARENT = "in_response_to_tweet_id"
VALID = f"coalesce(regexp_full_match({PARENT}, '[0-9]+'), false)"

# Named building blocks: name -> (body, names it reads)
CTE: dict[str, tuple[str, list[str]]] = {
    "tweets": (fx.duck(fx.TWEETS), []),
    "uniq": ("select * exclude(rn) from (select *, row_number() over (partition by tweet_id order by ingest_seq) rn "
             "from tweets) where rn=1", ["tweets"]),
    "climb": ("select tweet_id as start, tweet_id as cur, 0 as depth from uniq union all "
              "select c.start, p.tweet_id, c.depth+1 from climb c join uniq u on u.tweet_id=c.cur "
              f"join uniq p on p.tweet_id=u.{PARENT} and regexp_full_match(u.{PARENT}, '[0-9]+') where c.depth<5", ["uniq"]),
    "roots": ("select start as tweet_id, arg_max(cur, depth) as conversation_id from climb group by start", ["climb"]),
    "replies": (f"select {PARENT} as customer_tweet_id, author_id as brand, tweet_id as brand_tweet_id, text as brand_text "
                f"from (select *, row_number() over (partition by author_id, {PARENT} order by ingest_seq) rn from uniq "
                f"where not inbound and {VALID}) where rn=1", ["uniq"]),
    "pairs": ("select r.brand, o.conversation_id, r.customer_tweet_id, c.text as customer_text, r.brand_tweet_id, "
              "r.brand_text, c.created_at, 1 as turn from replies r join uniq c on c.tweet_id=r.customer_tweet_id and c.inbound "
              "join roots o on o.tweet_id=r.customer_tweet_id", ["replies", "roots"]),
    "cpairs": (f"select *, {clean('customer_text')} as customer_clean, {clean('brand_text')} as brand_clean from pairs "
               f"where length({clean('customer_text')})>5", ["pairs"]),
    "inb": (f"select * from uniq where inbound and {PARENT} in (select tweet_id from uniq where not inbound)", ["uniq"]),
    "labelled": (f"select l.*, r.conversation_id, {label('clean_text')} as intent from (select *, {clean('text')} as clean_text "
                 "from inb) l join roots r using (tweet_id) where length(clean_text)>5", ["inb", "roots"]),
    "convs": ("select conversation_id, row_number() over (order by md5('42:'||conversation_id), conversation_id) as r, "
              "count(*) over () as n from (select distinct conversation_id from labelled)", ["labelled"]),
    "splits": ("select tweet_id, clean_text, intent, conversation_id, case when r<=floor(n*0.7e0) then 'train' "
               "when r<=floor(n*0.7e0)+floor(n*0.15e0) then 'validation' else 'test' end as split "
               "from labelled join convs using (conversation_id)", ["labelled", "convs"]),
    "test": ("select *, length(clean_text) as text_len from splits where split='test'", ["splits"]),
    "edges": ("select intent as gi, quantile_cont(text_len, [0, 0.25, 0.5, 0.75, 1]) as e from test group by intent", ["test"]),
    "strata": ("select *, row_number() over (partition by intent, q order by h, tweet_id) rn from (select t.*, "
               "md5('42:'||tweet_id) as h, len(list_filter(list_distinct(e), lambda x: x>e[1] and x<text_len)) as q "
               "from test t join edges on gi=intent)", ["test", "edges"]),
    "golden": ("select row_number() over (order by h, tweet_id) as id, * from (select * from strata where rn<=greatest(1, "
               "greatest(15, 200//(select count(distinct intent) from test))//4) order by h, tweet_id limit 200)", ["strata", "test"]),
    "excluded": ("select distinct conversation_id from (select conversation_id from splits where split in ('test','validation') "
                 "union all select conversation_id from golden)", ["splits", "golden"]),
    "evidence": ("select * from cpairs where conversation_id in (select conversation_id from splits where split='train') "
                 "and conversation_id not in (select conversation_id from excluded)", ["cpairs", "splits", "excluded"]),
    "owner": ("select tweet_id, author_id as brand from (select *, row_number() over (partition by tweet_id order by ingest_seq) "
              "rn from tweets where not inbound) where rn=1", ["tweets"]),
    "inbound_by": (f"select t.*, o.brand from tweets t join owner o on o.tweet_id=t.{PARENT} where t.inbound", ["tweets", "owner"]),
    "btable": ("select coalesce(o.brand, i.brand) as brand, coalesce(outbound_tweets,0) as outbound_tweets, "
               "coalesce(inbound_msgs,0) as inbound_msgs, coalesce(conversations,0) as conversations from "
               "(select author_id as brand, count(tweet_id) as outbound_tweets from tweets where not inbound group by 1) o full join "
               f"(select brand, count(tweet_id) as inbound_msgs, count(distinct {PARENT}) as conversations from inbound_by group by 1) i "
               "on o.brand=i.brand", ["tweets", "inbound_by"]),
    "usable": ("select brand, count(*) filter (tweet_id in (select " + PARENT + " from tweets where not inbound and " + PARENT +
               " is not null)) as usable_pairs, count(tweet_id) as total from inbound_by group by brand", ["inbound_by"]),
    "brands": ("select b.*, coalesce(usable_pairs,0) as usable_pairs, coalesce(" + re_("usable_pairs*1e0/total", 3) +
               ",0e0) as reply_rate from btable b left join usable u using (brand)", ["btable", "usable"]),
    "ranked": ("select *, (inbound_msgs_norm+conversations_norm+usable_pairs_norm+reply_rate_norm)/4e0 as composite_score from ("
               "select b.*, " + ", ".join(
                   f"case when max({m}) over ()>min({m}) over () then cast({m}-min({m}) over () as double)/"
                   f"cast(max({m}) over ()-min({m}) over () as double) else 0e0 end as {m}_norm"
                   for m in ("inbound_msgs", "conversations", "usable_pairs", "reply_rate")) +
               " from brands b where inbound_msgs>=1)", ["brands"]),
    "decisions": (fx.duck(fx.DECISIONS), []),
    "risked": (f"select *, {re_('0.5e0*(1e0-confidence)+0.5e0*(1e0-evidence_score)', 4)} as composite_risk from decisions", ["decisions"]),
    "gated": ("select *, case when gate_triggered='none' then 'AUTO_HANDLE' else 'ESCALATE' end as decision from (select *, case "
              "when intent in ('account_access','billing_payment') then 'high_risk_intent' when confidence<0.6e0 then 'low_confidence' "
              "when n_evidence=0 then 'no_evidence' when evidence_score<0.3e0 then 'weak_evidence' when composite_risk>0.5e0 "
              "then 'composite_risk' else 'none' end as gate_triggered from risked)", ["risked"]),
    "preds": (fx.duck(fx.PREDICTIONS), []),
    "annotations": (fx.duck(fx.ANNOTATIONS), []),
    "legacy": (fx.duck(fx.LEGACY), ["annotations"]),
    "judge_raw": (fx.duck(fx.JUDGE_RAW), []),
    "ratings": (fx.duck(fx.RATINGS), []),
    "emb": ("select vec_id, v, sqrt(list_inner_product(v,v)) as nv from (select vec_id, cast(embedding as double[]) as v from embeddings)", []),
    "sims": ("select q.vec_id as query_id, s.vec_id as store_id, round(list_inner_product(q.v,s.v)/(q.nv*s.nv), 12) as score "
             "from emb q, emb s", ["emb"]),
    "topk": (f"select query_id, rank, store_id, {re_('score', 4)} as similarity from (select *, row_number() over "
             "(partition by query_id order by score desc, store_id) as rank from sims) where rank<=5", ["sims"]),
    "cases": ("select d.doc_id as vec_id, text as customer_text, source as brand_text, lang as conversation_id, v, nv from documents d "
              "join emb e on e.vec_id=d.doc_id%(select count(*) from embeddings)", ["emb"]),
    # documents share the few vectors, so vectors are matched first; a vector stands for its documents, smallest id first
    "vectop": ("select query_id, store_id, score from (select *, row_number() over (partition by query_id order by score desc, store_id) as rn "
               "from sims where store_id in (select e from casevec) and query_id in (select e from casevec)) where rn<=6", ["sims", "casevec"]),
    "casevec": ("select doc_id as id, doc_id%(select count(*) from embeddings) as e from documents", []),
    "casetop": (f"select query_id, rank, store_id, {re_('score', 4)} as similarity from (select *, row_number() over "
                "(partition by query_id order by score desc, store_id) as rank from (select q.id as query_id, s.id as store_id, t.score "
                "from casevec q join vectop t on t.query_id=q.e join casevec s on s.e=t.store_id where q.id<>s.id)) where rank<=5", ["vectop", "casevec"]),
    "matched": ("select c.vec_id, c.customer_text as message, c.conversation_id, m.* from cases c join (select query_id, "
                f"list(struct_pack(c:=s.customer_text, b:=s.brand_text) order by rank) as ev, {re_('avg(similarity)', 4)} as evidence_score "
                "from casetop join cases s on s.vec_id=store_id group by query_id) m on m.query_id=c.vec_id", ["cases", "casetop"]),
}

# Signed random projections in integers, as the index computes them: codes of stored vectors, codes and probes of queries.
CTE |= {
    "annfixed": ("select vec_id, list_transform(v, lambda x: floor(x/nv*1048576+0.5)::bigint) as f from emb", ["emb"]),
    "annplanes": (f"select t, b, list(case when ('0x'||substr(md5('0:'||t||':'||b||':'||d), 1, 1))::int%2=0 then 1 else -1 end order by d) as p "
                  f"from (select unnest(range({vi.TABLES})) as t), (select unnest(range({vi.BITS})) as b), (select unnest(range(64)) as d) group by t, b", []),
    "annside": ("select vec_id, t, b, list_sum(list_transform(list_zip(f, p), lambda z: z[1]*z[2]))::bigint as side from annfixed, annplanes", ["annfixed", "annplanes"]),
    "anncode": ("select vec_id, t, sum(case when side>0 then 1<<b::int else 0 end)::int as code from annside group by vec_id, t", ["annside"]),
    "annprobe": (f"select vec_id, t, code from anncode union all select c.vec_id, c.t, xor(c.code, (1<<w.b::int)::int) from anncode c join (select *, row_number() over "
                 f"(partition by vec_id, t order by abs(side), b) as rn from annside) w on w.vec_id=c.vec_id and w.t=c.t and rn<={vi.PROBES}", ["anncode", "annside"]),
    "annpairs": ("select distinct q.vec_id as query_id, s.vec_id as store_id from annprobe q join anncode s on s.t=q.t and s.code=q.code", ["annprobe", "anncode"]),
}
ANN = f"""
  select query_id, rank, store_id, similarity from (
    select query_id, store_id, {re_('score', 4)} as similarity, row_number() over (partition by query_id order by score desc, store_id) as rank,
      count(*) over (partition by query_id) as n from sims join annpairs using (query_id, store_id)) where rank<=5 and n>=5
  union all
  select * from topk where query_id not in (select query_id from annpairs group by query_id having count(*)>=5)"""


def with_(names: list[str], body: str) -> str:
    """Prefix ``body`` with the blocks it needs, in dependency order."""
    order: list[str] = []

    def visit(name):
        if name not in order:
            for dep in CTE[name][1]:
                visit(dep)
            order.append(name)

    for n in names:
        visit(n)
    return "with recursive " + ",\n".join(f"{n} as ({CTE[n][0]})" for n in order) + "\n" + body


def scores(source: str, by: str = "", where: str = "true", true: str = "y_true", pred: str = "y_pred") -> str:
    """Per-label support/predicted/tp and the derived scores, straight from rows."""
    k = f"{by}, " if by else ""
    return (f"select *, case when predicted>0 then tp*1e0/predicted else 0e0 end as p, "
            f"case when support>0 then tp*1e0/support else 0e0 end as r, "
            f"case when support+predicted>0 then 2e0*tp/(support+predicted) else 0e0 end as f1 from ("
            f"select {k}label, sum(s) as support, sum(pd) as predicted, sum(hit) as tp from ("
            f"select {k}{true} as label, 1 as s, 0 as pd, ({true}={pred})::int as hit from {source} where {where} union all "
            f"select {k}{pred}, 0, 1, 0 from {source} where {where}) group by {k}label)")


def metric_row(inner: str, by: str = "", digits: int = 4) -> str:
    k = f"{by}, " if by else ""
    g = f" group by {by}" if by else ""
    return (f"select {k}cast(sum(support) as bigint) as n_samples, {re_('sum(tp)*1e0/sum(support)', digits)} as accuracy, {re_('avg(f1)', digits)} as macro_f1, "
            f"{re_('sum(f1*support)/sum(support)', digits)} as weighted_f1, {re_('avg(p)', digits)} as macro_precision, "
            f"{re_('avg(r)', digits)} as macro_recall from ({inner}){g}")


def escalation(source: str, true: str = "truth") -> str:
    tp, fp = f"count(*) filter ({true}='ESCALATE' and decision='ESCALATE')", f"count(*) filter ({true}='AUTO_HANDLE' and decision='ESCALATE')"
    fn = f"count(*) filter ({true}='ESCALATE' and decision='AUTO_HANDLE')"
    return (f"select {re_('pr', 4)} as escalation_precision, {re_('rc', 4)} as escalation_recall, "
            f"{re_('case when pr+rc>0 then 2*pr*rc/(pr+rc) else 0e0 end', 4)} as escalation_f1, n_true_escalate, n_pred_escalate from ("
            f"select case when {tp}+{fp}>0 then {tp}*1e0/({tp}+{fp}) else 0e0 end as pr, "
            f"case when {tp}+{fn}>0 then {tp}*1e0/({tp}+{fn}) else 0e0 end as rc, count(*) filter ({true}='ESCALATE') as n_true_escalate, "
            f"count(*) filter (decision='ESCALATE') as n_pred_escalate from {source})")


TRUTH = f"case when upper({strip('answer')}) in ('YES','TRUE','1','ESCALATE') then 'ESCALATE' else 'AUTO_HANDLE' end"
ESC = ("case {x} when 'Y' then 'YES' when 'N' then 'NO' when 'HANDLE' then 'AUTO_HANDLE' when 'REVIEW' then 'ESCALATE' "
       "else {x} end").format(x=f"upper({strip('should_escalate')})")

# ---- judge output parsing
_SCORE = "json_extract(j, '$.{d}.score')"


def _judge_blocks() -> str:
    cols = []
    for d in JUDGE_DIMENSIONS:
        t, st = f"json_type(j, '$.{d}')", f"json_type(j, '$.{d}.score')"
        text = f"json_extract_string(j, '$.{d}.score')"
        cols.append(
            f"case when {t} is null then 3 when {t}<>'OBJECT' then null when {st} is null then 3 "
            f"when {st}='VARCHAR' then case when regexp_full_match({text}, '\\s*[+-]?[0-9]+\\s*') then cast(trim({text}) as int) end "
            f"when {st} in ('BIGINT','UBIGINT') then cast({text} as int) when {st}='DOUBLE' then cast(trunc(cast({text} as double)) as int) "
            f"when {st}='BOOLEAN' then ({text}='true')::int end as s_{d}")
        rt, rtext = f"json_type(j, '$.{d}.reason')", f"json_extract_string(j, '$.{d}.reason')"
        cols.append(f"case when {t} is null then 'not scored' when {rt} is null then '' when {rt}='NULL' then 'None' "
                    f"when {rt}='BOOLEAN' then case {rtext} when 'true' then 'True' else 'False' end else {rtext} end as r_{d}")
    bad = " or ".join(f"s_{d} is null" for d in JUDGE_DIMENSIONS)
    return (f"select *, (j is null or {bad}) as bad from (select *, {', '.join(cols)} from (select *, try_cast(regexp_extract("
            "regexp_replace(regexp_replace(raw_output, '```json\\s*', '', 'g'), '```\\s*', '', 'g'), '(?s)\\{.*\\}') as json) as j from judge_raw))")


CTE["judged"] = (_judge_blocks(), ["judge_raw"])
_total = "+".join(f"(case when bad then 3 else s_{d} end)" for d in JUDGE_DIMENSIONS)
JUDGE_COLS = ", ".join(
    f"case when bad then 3 else s_{d} end as judge_{d}, case when bad then 'judge unavailable' else r_{d} end as judge_{d}_reason"
    for d in JUDGE_DIMENSIONS) + f", {re_(f'({_total})/7e0', 2)} as judge_mean"

# ---- annotation checks
CTE["normal"] = (
    f"select *, {ESC} as esc, {strip('tweet_id')} as tid, case when {strip('text')}='' then "
    "'Annotation record is missing required fields: text.' when gold_intent<>'' and gold_intent not in "
    f"({', '.join(lit(i) for i in INTENTS)}) then concat('gold_intent ''', gold_intent, ''' is not valid for this schema.') "
    f"when {ESC} not in ('','YES','NO','AUTO_HANDLE','ESCALATE') then concat('Escalation ''', {ESC}, "
    "''' must be YES, NO, AUTO_HANDLE, or ESCALATE.') end as e1 from annotations", ["annotations"])
CTE["by_id"] = ("select *, case when e1 is not null then e1 when row_no>min(row_no) filter (e1 is null) over (partition by id) "
                "then concat('duplicate id ''', id, '''') end as e2 from normal", ["normal"])
CTE["checked"] = ("select *, case when e2 is not null then e2 when tid<>'' and row_no>min(row_no) filter (e2 is null) over "
                  "(partition by tid) then concat('duplicate tweet_id ''', tid, '''') end as error from by_id", ["by_id"])

# ---- tf-idf
_STOPS = ", ".join(lit(w) for w in fx.STOP_WORDS)


def tfidf(min_df: int, max_df: float, cap: int, sublinear: bool, stops: bool) -> dict[str, tuple[str, list[str]]]:
    keep = f"list_filter(t, lambda x: x not in ({_STOPS}))" if stops else "t"
    tf = "1e0+ln(tf)" if sublinear else "tf*1e0"
    return {
        "toks": (f"select doc_id, {keep} as t from (select doc_id, regexp_extract_all(lower(text), '[{W}]{{2,}}') as t from documents)", []),
        "counts": ("select doc_id, term, count(*) as tf from (select doc_id, unnest(list_concat(t, list_transform(range(1, len(t)), "
                   "lambda i: concat(t[i], ' ', t[i+1])))) as term from toks) group by all", ["toks"]),
        "vocab": (f"select term, row_number() over (order by term)-1 as idx, df, cf, ln((n+1e0)/(df+1e0))+1e0 as idf from (select term, "
                  f"count(*) as df, cast(sum(tf) as bigint) as cf, (select count(*) from documents) as n from counts group by term) "
                  f"where df>={min_df} and df<=n*{max_df}e0 order by cf desc, term limit {cap}", ["counts"]),
        "weights": (f"select doc_id, term, w/sqrt(sum(w*w) over (partition by doc_id)) as weight from (select doc_id, term, ({tf})*idf as w "
                    "from counts join vocab using (term))", ["vocab"]),
    }


def with_tfidf(names: list[str], body: str, **spec) -> str:
    saved = {k: CTE.get(k) for k in ("toks", "counts", "vocab", "weights")}
    CTE.update(tfidf(**spec))
    try:
        return with_(names, body)
    finally:
        for k, v in saved.items():
            if v is None:
                CTE.pop(k)
            else:
                CTE[k] = v


CLASSIFIER = {"min_df": 2, "max_df": 0.95, "cap": 10000, "sublinear": True, "stops": False}
DISCOVERY = {"min_df": 5, "max_df": 0.85, "cap": 5000, "sublinear": False, "stops": True}

_HEAD, _TAIL = SYSTEM_RULES.split("{brand}")
GEN_PROMPT = (
    f"concat({lit(_HEAD)}, 'Acme', {lit(_TAIL)}, chr(10), chr(10), 'Intent: ', conversation_id, ' (confidence: ', {f2('evidence_score')}, ')', "
    "chr(10), chr(10), 'Historical support examples:', chr(10), array_to_string(list_transform(ev, lambda x, i: concat('Example ', i, ':', chr(10), "
    "'  Customer: ', x.c, chr(10), '  Support:  ', x.b)), chr(10)||chr(10)), chr(10), chr(10), 'Customer message: \"', message, '\"', "
    "chr(10), chr(10), 'Support reply:')")
_RUBRIC = "\n".join(f'  "{d}": {{"score": <1-5>, "reason": "<one sentence>"}}' for d in JUDGE_DIMENSIONS)
JUDGE_PROMPT = (
    "concat('You are evaluating an AppleSupport reply. Score each criterion 1 (poor) to 5 (excellent).', chr(10), chr(10), "
    "'Customer message: \"', message, '\"', chr(10), 'Detected intent: ', conversation_id, chr(10), 'Decision: ESCALATE', chr(10), "
    "'Historical examples used:', chr(10), array_to_string(list_transform(ev[1:3], lambda x, i: concat('  [', i, '] Customer: ', x.c[1:100], "
    "' | Support: ', x.b[1:100])), chr(10)), chr(10), chr(10), 'Generated reply: \"', ev[1].b, '\"', chr(10), chr(10), "
    f"{lit('Respond ONLY with valid JSON in this exact format:')}, chr(10), {lit('{' + chr(10) + _RUBRIC + chr(10) + '}')})")

_RAW = (f"tweet_id, author_id, inbound, {stamp()} as created_at, text, response_tweet_id, {PARENT}")
_GRID = ", ".join(f"({c}e0,{s}e0)" for c in (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9) for s in (0.1, 0.2, 0.3, 0.4, 0.5))
CTE["auto"] = (f"select g.ct, g.st, true_intent as y_true, intent as y_pred from risked, (values {_GRID}) g(ct,st) where intent not in "
               "('account_access','billing_payment') and confidence>=g.ct and evidence_score>=g.st and composite_risk<=0.5e0", ["risked"])
CTE["grid"] = ("select ct as classifier_threshold, st as retrieval_threshold, cast(sum(support) as bigint) as n_auto, avg(f1) as macro_f1, "
               "sum(support)*1e0/(select count(*) from decisions) as auto_handle_rate from (" + scores("auto", "ct, st") +
               ") group by ct, st having sum(support)>=10", ["auto", "decisions"])
_DIM = "['" + "','".join(JUDGE_DIMENSIONS) + "'][dim+1]"
CTE["long"] = (f"select id, {_DIM} as dimension, human, judge from ratings", ["ratings"])
CTE["pooled"] = ("select dimension, human, judge from long where human is not null and judge is not null union all "
               "select 'overall', human, judge from long where human is not null and judge is not null", ["long"])
CTE["ranks"] = ("select dimension as d, list_sort(list(distinct v)) as vals from (select dimension, human as v from pooled union all "
                "select dimension, judge from pooled) group by 1", ["pooled"])
CTE["coded"] = ("select *, list_position(vals, human)*1e0 as i, list_position(vals, judge)*1e0 as j from pooled join ranks on d=dimension",
                ["pooled", "ranks"])
_GOLD = ("id, tweet_id, conversation_id, clean_text as text, intent as auto_intent, '' as gold_intent, '' as should_escalate, "
         "'' as gold_reply_quality, case when id<=50 then 'YES' else 'NO' end as double_label, '' as notes")

ORACLES: dict[str, str] = {
    "load_messages": with_(["tweets"], f"select {_RAW}, row_number() over (partition by author_id order by ingest_seq) as place from tweets"),
    "normalize_messages": with_(["tweets"], f"select {_RAW}, ingest_seq from tweets"),
    "read_annotations": with_(["annotations"], "select id, tweet_id, conversation_id, text, gold_intent, should_escalate, notes from annotations"),
    "intent_dimension": "select lang as intent from documents where lang not like '\\_%' escape '\\' union select source from documents where source not like '\\_%' escape '\\'",
    "write_splits": with_(["splits"], "select * from splits"),
    "write_evidence_store": with_(["evidence", "uniq"], f"""select e.customer_tweet_id as store_id, e.conversation_id, e.customer_clean, e.brand_text,
        {stamp('e.created_at')} as created_at, len(x.embedding) as dim, 1e0 as norm from evidence e join uniq u on u.tweet_id=e.customer_tweet_id
        join embeddings x on x.vec_id=u.ingest_seq % (select count(*) from embeddings)"""),
    "write_metrics": with_(["preds"], "select y_true, " + ", ".join(f"count(*) filter (y_pred='{x}') as {x}" for x in ("de", "en", "es", "fr", "other")) +
                           " from (select y_true, y_pred from preds union all select l, null from (select unnest([y_true, y_pred]) as l from preds)) group by y_true"),
    "clean_messages": with_(["tweets"], f"select tweet_id, ingest_seq, {clean('text')} as clean_text from tweets"),
    "drop_empty": with_(["tweets"], f"select tweet_id, ingest_seq, {clean('text')} as clean_text from tweets where length({clean('text')})>5"),
    "valid_reply_ids": with_(["tweets"], f"select tweet_id, ingest_seq, {VALID} as valid_parent from tweets"),
    "label_intents": with_(["tweets"], f"select tweet_id, ingest_seq, {label(clean('text'))} as intent from tweets"),
    "conversation_proxy": with_(["tweets"], f"select tweet_id, ingest_seq, coalesce({PARENT}, tweet_id) as conversation_id from tweets"),
    "length_histogram": with_(["tweets"], f"""select bin, {re_('lo+(hi-lo)*1e0/60e0*bin', 4)} as bin_start, {re_('lo+(hi-lo)*1e0/60e0*(bin+1)', 4)} as bin_end,
        (select count(*) from tweets where text is not null and least(59, (least(length(text),300)-lo)*60//(hi-lo))=bin) as n, median_length
        from (select unnest(range(60))::int as bin, * from (select min(least(length(text),300)) as lo, max(least(length(text),300)) as hi,
        cast(median(length(text)) as double) as median_length from tweets))"""),
    "generation_prompts": with_(["matched"], f"select vec_id, length({GEN_PROMPT}) as n_chars, md5({GEN_PROMPT}) as prompt_md5 from matched"),
    "judge_prompts": with_(["matched"], f"select vec_id, {JUDGE_PROMPT} as prompt from matched"),
    "template_replies": with_(["decisions"], "select event_id, case when n_evidence>1 then concat('reply ', event_id) when n_evidence=1 then " +
                              lit(GENERIC_REPLY) + " else case intent " + " ".join(f"when '{k}' then {lit(v)}" for k, v in REPLY_TEMPLATES.items()) +
                              " end end as reply, n_evidence>1 as grounded from decisions"),
    "parse_judge_outputs": with_(["judged"], f"select doc_id, {JUDGE_COLS} from judged"),
    "evidence_from_json": with_(["judge_raw"], "select doc_id, case when doc_id%7=0 then 0 else 1 end as n_evidence, case when doc_id%7<>0 then concat(intent, ' case') end as first_case from judge_raw"),
    "canonical_escalation": with_(["annotations"], f"select row_no, {ESC} as gold_escalation from annotations"),
    "normalize_truth_decision": with_(["decisions"], f"select event_id, {TRUTH} as truth from decisions"),
    "conversation_pairs": with_(["pairs"], f"select * exclude(created_at), {stamp()} as created_at from pairs"),
    "thread_roots": with_(["roots"], "select * from roots"),
    "brand_inbound": with_(["inb"], f"select tweet_id, {PARENT}, text, {stamp()} as created_at from inb"),
    "attribute_brand": with_(["inbound_by"], "select tweet_id, ingest_seq, brand from inbound_by"),
    "brand_table": with_(["btable"], "select * from btable"),
    "usable_pairs": with_(["brands"], "select * from brands"),
    "evidence_candidates": with_(["evidence"], "select conversation_id, customer_tweet_id, brand_tweet_id, customer_clean, brand_clean from evidence"),
    "golden_backfill": with_(["annotations", "legacy"], """select a.row_no, a.tweet_id, case when a.gold_intent='' and l.tweet_id is not null then l.gold_intent else a.gold_intent end as gold_intent,
        case when a.should_escalate='' and l.tweet_id is not null then l.should_escalate else a.should_escalate end as gold_escalation_label,
        case when l.tweet_id is not null then l.gold_reply_quality else '' end as gold_reply_quality_label,
        case when a.notes='' and l.tweet_id is not null then l.notes else a.notes end as notes
        from annotations a left join (select * from (select *, row_number() over (partition by tweet_id order by row_no) rn from legacy) where rn=1) l on l.tweet_id=a.tweet_id"""),
    "rater_join": with_(["long"], "select id, dimension, cast(human as int) as human, cast(judge as int) as judge from long"),
    "topk_similar": with_(["topk"], "select * from topk"),
    "topk_similar_tiled": with_(["topk"], "select * from topk"),
    "ann_topk": with_(["annpairs", "topk"], ANN),
    "dataset_summary": with_(["tweets"], f"""select count(*) as total_rows, count_if(inbound) as inbound_rows, count_if(not inbound) as outbound_rows,
        {re_('count_if(inbound)*100e0/count(*)', 2)} as inbound_pct,
        count(*)-(select count(*) from (select distinct * exclude(ingest_seq) from tweets)) as duplicate_rows,
        count(*)-(select count(*) from (select distinct tweet_id from tweets)) as duplicate_tweet_ids,
        count_if(text is null) as missing_text, count_if(response_tweet_id is null) as missing_response_id, count(distinct author_id) as unique_authors,
        {stamp('min(created_at)')} as date_min, {stamp('max(created_at)')} as date_max, {re_('avg(length(text))', 1)} as text_len_mean,
        {re_('quantile_cont(length(text), 0.5)', 1)} as text_len_median, min(length(text)) as text_len_min, max(length(text)) as text_len_max,
        {re_('quantile_cont(length(text), 0.95)', 1)} as text_len_p95 from tweets"""),
    "brand_scores": with_(["ranked"], "select brand, outbound_tweets, inbound_msgs, conversations, usable_pairs, reply_rate, " + ", ".join(
        f"{re_(c, 9)} as {c}" for c in ("inbound_msgs_norm", "conversations_norm", "usable_pairs_norm", "reply_rate_norm", "composite_score")) + " from ranked"),
    "select_brand": with_(["ranked"], f"select brand, {re_('composite_score', 9)} as composite_score from ranked r order by r.composite_score desc, brand limit 1"),
    "top_brands": with_(["btable"], "select * from btable order by inbound_msgs desc, brand limit 20"),
    "intent_distribution": with_(["tweets"], f"select intent, count(*) as n from (select {label('c')} as intent from (select {clean('text')} as c from tweets) where length(c)>0) group by intent"),
    "confusion_matrix": with_(["preds"], """select a.l as y_true, b.l as y_pred, (select count(*) from preds where y_true=a.l and y_pred=b.l) as n
        from (select y_true as l from preds union select y_pred from preds) a, (select y_true as l from preds union select y_pred from preds) b"""),
    "classification_report": with_(["preds"], f"select label, {re_('p', 4)} as precision, {re_('r', 4)} as recall, {re_('f1', 4)} as f1, cast(support as bigint) as support from ({scores('preds')})"),
    "classifier_metrics": with_(["preds"], metric_row(scores("preds"))),
    "escalation_metrics": with_(["gated"], escalation("gated")),
    "model_comparison": with_(["preds"], "select * exclude(n_samples) from (" + metric_row(scores(
        "(select 'keyword' as model, y_true, y_pred from preds union all select 'majority_baseline', y_true, (select y_true from preds group by y_true "
        "order by count(*) desc, y_true limit 1) from preds) m", "model"), "model") + ")"),
    "evidence_score": with_(["topk"], f"select query_id, count(*) as n_evidence, {re_('avg(similarity)', 4)} as evidence_score from topk group by query_id"),
    "similarity_distribution": with_(["topk"], f"""select count(*) as n, {re_('avg(similarity)', 3)} as mean, {re_('median(similarity)', 3)} as median,
        {re_('min(similarity)', 3)} as min, {re_('max(similarity)', 3)} as max, {re_('avg(case when similarity>0.5e0 then 100e0 else 0e0 end)', 1)} as pct_above_05,
        {re_('avg(case when similarity>0.3e0 then 100e0 else 0e0 end)', 1)} as pct_above_03 from topk
        where query_id in (select vec_id from embeddings order by md5('42:'||vec_id), cast(vec_id as varchar) limit 200)"""),
    "auto_vs_gold": with_(["annotations"], "select n_samples as n_labelled, accuracy, macro_f1 from (" + metric_row(
        scores("annotations", where="trim(gold_intent)<>''", true="gold_intent", pred="auto_intent"), digits=3) + ")"),
    "rater_agreement": with_(["coded"], f"""select dimension, count(*) as n, {re_('1-avg((i-j)*(i-j))/((avg(i)-avg(j))*(avg(i)-avg(j))+var_pop(i)+var_pop(j))', 3)} as kappa,
        {re_('corr(human, judge)', 3)} as pearson_r, {re_('avg(abs(human-judge))', 3)} as mae, {re_('avg((human=judge)::int)', 3)} as exact_agreement,
        case when (select count(*) from documents)<30 then 'Results not statistically reliable (n<30)' end as warning from coded group by dimension"""),
    "judge_summary": with_(["judged"], "select count(*) as n, " + ", ".join(f"{re_(f'avg(judge_{d})', 3)} as {d}" for d in JUDGE_DIMENSIONS) +
                           f", {re_('avg(judge_mean)', 3)} as overall_mean from (select {JUDGE_COLS} from judged)"),
    "error_pairs": with_(["preds"], f"""select y_true, y_pred, count(*) as errors, (select count(*) from preds where y_true<>y_pred) as total_errors,
        {re_('(select count(*) from preds where y_true<>y_pred)*1e0/(select count(*) from preds)', 4)} as error_rate from preds where y_true<>y_pred
        group by y_true, y_pred order by errors desc, y_true, y_pred limit 5"""),
    "threshold_grid": with_(["grid"], f"select classifier_threshold, retrieval_threshold, n_auto, {re_('macro_f1', 6)} as macro_f1, {re_('auto_handle_rate', 6)} as auto_handle_rate from grid"),
    "best_thresholds": with_(["grid"], f"""select {re_('classifier_threshold', 2)} as classifier_threshold, {re_('retrieval_threshold', 2)} as retrieval_threshold,
        {re_('macro_f1', 4)} as val_f1, {re_('auto_handle_rate', 3)} as auto_handle_rate from (select * from grid order by round(macro_f1, 12) desc, classifier_threshold, retrieval_threshold limit 1)"""),
    "annotation_summary": with_(["checked"], """select count(*) as rows, count_if(error is null and gold_intent<>'' and esc<>'') as labelled,
        count(*)-count_if(error is null and gold_intent<>'' and esc<>'') as unlabelled, count_if(error is not null) as errors from checked"""),
    "leaked_conversations": with_(["splits", "golden", "cpairs"], """select check_name, conversation_id from (
        with rows as (select conversation_id as c, split from splits union all select conversation_id, 'train' from splits where split='test' and ends_with(tweet_id, '01')),
          test as (select distinct c from rows where split='test')
        select 'train_test_overlap' as check_name, c as conversation_id from test where c in (select c from rows where split='train')
        union all select 'validation_test_overlap', c from test where c in (select c from rows where split='validation')
        union all select 'indexed_test_overlap', c from test where c in (select conversation_id from cpairs)
        union all select distinct 'indexed_golden_overlap', conversation_id from golden where conversation_id<>'' and conversation_id in (select conversation_id from cpairs))"""),
    "shared_texts": """with ranked as (select doc_id::varchar as c, text, row_number() over (order by md5('42:'||doc_id), doc_id::varchar) as r, count(*) over () as n from documents),
        rows as (select *, case when r<=floor(n*0.7e0) then 'train' when r<=floor(n*0.7e0)+floor(n*0.15e0) then 'validation' else 'test' end as split from ranked)
        select md5(text) as text_md5, count(*) filter (split='train') as train, count(*) filter (split='validation') as validation,
        count(*) filter (split='test') as test, count(distinct c) as conversations from rows group by md5(text) having count(distinct split)>1""",
    "bootstrap_ci": with_(["preds"], f"""select {', '.join(f"{re_(f'quantile_cont({m}, {q})', 4)} as {m}_{end}" for m in ('accuracy', 'macro_f1') for q, end in ((0.025, 'low'), (0.975, 'high')))} from (
        with cells as (select y_true, y_pred, count(*) as n from preds group by 1, 2),
          drawn as (select it, y_true, y_pred, greatest(0, floor(n + sqrt(n)*z + (z*z-1e0)/6e0 + (z-z*z*z)/(72e0*sqrt(n)) + 0.5e0))::bigint as n from (
            select *, sqrt(-2e0*ln((('0x'||substr(h, 1, 8))::bigint+0.5e0)/4294967296e0))*cos(2e0*pi()*((('0x'||substr(h, 9, 8))::bigint+0.5e0)/4294967296e0)) as z from (
              select *, md5('42|'||it||'|'||y_true||'|'||y_pred) as h from cells, (select unnest(range(1000)) as it)))),
          names as (select y_true as label from cells union select y_pred from cells),
          f as (select it, label, sum(case when y_true=label and y_pred=label then n else 0 end) as tp, sum(case when y_true=label then n else 0 end) as t,
            sum(case when y_pred=label then n else 0 end) as p from drawn, names group by it, label)
        select it, sum(tp)*1e0/any_value(total) as accuracy, avg(case when t+p>0 then 2e0*tp/(t+p) else 0e0 end) as macro_f1
        from f join (select it, sum(n) as total from drawn group by it) using (it) group by it)"""),
    "leakage_audit": with_(["splits", "golden", "cpairs", "evidence", "excluded"], """select check_name, n, must_be_zero, not must_be_zero or n=0 as passed from (
        select 'train_test_overlap' as check_name, count(*) as n, true as must_be_zero from (select conversation_id from splits where split='train' intersect select conversation_id from splits where split='test')
        union all select 'validation_test_overlap', count(*), true from (select conversation_id from splits where split='validation' intersect select conversation_id from splits where split='test')
        union all select 'indexed_test_overlap', count(*), true from (select conversation_id from evidence intersect select conversation_id from splits where split='test')
        union all select 'indexed_golden_overlap', count(*), true from (select conversation_id from evidence intersect select conversation_id from golden)
        union all select 'pairs_in_train', count(*), false from cpairs where conversation_id in (select conversation_id from splits where split='train')
        union all select 'pairs_excluded', count(*), false from cpairs where conversation_id in (select conversation_id from excluded)
        union all select 'pairs_indexed', count(*), false from evidence)"""),
    "exclusion_set": with_(["excluded"], "select * from excluded"),
    "dedup_keep_first": with_(["uniq"], "select tweet_id, author_id, text, ingest_seq from uniq"),
    "first_reply": with_(["replies"], "select * from replies"),
    "length_quartiles": with_(["tweets"], f"""select tweet_id, ingest_seq, intent, text_len, len(list_filter(list_distinct(e), lambda x: x>e[1] and x<text_len)) as len_quartile
        from (select *, quantile_cont(text_len, [0, 0.25, 0.5, 0.75, 1]) over (partition by intent) as e from (select *, {label('c')} as intent, length(c) as text_len
        from (select *, {clean('text')} as c from tweets)) where text_len>0)"""),
    "golden_sample": with_(["golden"], f"select {_GOLD} from golden"),
    "golden_set": with_(["strata"], """select row_number() over (order by h, tweet_id) as id, tweet_id, conversation_id, clean_text as text, intent as auto_intent, '' as gold_intent,
        '' as gold_reply_quality_label, '' as gold_escalation_label, '' as notes from (select * from strata where rn<=6 order by h, tweet_id limit 200)"""),
    "double_label_subset": with_(["golden"], """select id, clean_text as text, intent as auto_intent, '' as human_a_intent, '' as human_b_intent, '' as human_a_escalation,
        '' as human_b_escalation, '' as human_a_notes, '' as human_b_notes, '' as notes from golden order by id limit 50"""),
    "calibration_template": with_(["annotations"], "select row_no as id, text, auto_intent as intent, '' as generated_reply, '' as notes, " + ", ".join(
        f"'' as {d}" for d in JUDGE_DIMENSIONS) + " from annotations order by md5('42:'||row_no), row_no limit 30"),
    "error_examples": with_(["preds"], """select y_true, y_pred, errors, example, text[1:80] as text from (select *, row_number() over (partition by y_true, y_pred order by doc_id) as example
        from preds where y_true<>y_pred) join (select y_true, y_pred, count(*) as errors from preds where y_true<>y_pred group by 1, 2 order by 3 desc, 1, 2 limit 5)
        using (y_true, y_pred) where example<=2"""),
    "error_list": with_(["preds"], "select doc_id, text, y_true, y_pred from preds where y_true<>y_pred order by doc_id limit 100"),
    "prepare_splits": with_(["inb", "roots"], f"""select tweet_id, clean_text, intent, conversation_id, case when r<=floor(n*0.7e0) then 'train'
        when r<=floor(n*0.7e0)+floor(n*0.15e0) then 'validation' else 'test' end as split from (
        select *, {label('clean_text')} as intent, dense_rank() over (order by md5('42:'||conversation_id), conversation_id) as r, (count(distinct conversation_id) over ()) as n from (
        select i.tweet_id, {clean('text')} as clean_text, conversation_id from (select * from inb order by md5('42:'||tweet_id), tweet_id limit 20000) i join roots using (tweet_id))
        where length(clean_text)>5)"""),
    "conversation_split": with_(["splits"], "select tweet_id, conversation_id, split from splits"),
    "reproducible_sample": with_(["uniq"], "select tweet_id, ingest_seq from uniq order by md5('42:'||tweet_id), tweet_id limit 500"),
    "escalation_gates": with_(["gated"], f"""select event_id, intent, decision, gate_triggered, case gate_triggered
        when 'high_risk_intent' then concat('Intent ''', intent, ''' is high-risk (financial/security). Always requires human review.')
        when 'low_confidence' then concat('Classifier confidence ', {f2('confidence')}, ' < threshold 0.6. Intent prediction is uncertain.')
        when 'no_evidence' then 'No historical support examples retrieved. Cannot generate a grounded response.'
        when 'weak_evidence' then concat('Retrieval evidence score ', {f2('evidence_score')}, ' < threshold 0.3. Historical examples are not sufficiently similar.')
        when 'composite_risk' then concat('Composite risk score ', {f2('composite_risk')}, ' > 0.5 (confidence=', {f2('confidence')}, ', evidence=', {f2('evidence_score')}, '). Combined uncertainty too high.')
        else concat('All gates passed: confidence=', {f2('confidence')}, ', evidence_score=', {f2('evidence_score')}, ', composite_risk=', {f2('composite_risk')}, ', ', n_evidence, ' examples retrieved.') end as reason,
        composite_risk, {re_('confidence', 4)} as classifier_confidence, {re_('evidence_score', 4)} as evidence_score from gated"""),
    "golden_escalation_eval": with_(["gated"], escalation(f"(select * replace({TRUTH} as truth) from gated where trim(answer)<>'') g")),
    "validate_annotations": with_(["checked"], "select row_no, id, tid as tweet_id, gold_intent, esc as gold_escalation, case when error is not null then concat('row ', row_no, ': ', error) end as message from checked"),
    "duplicate_annotations": with_(["checked"], "select row_no, error from checked where error like 'duplicate%'"),
    "batch_judge": with_(["judged"], f"select id, {JUDGE_COLS} from judged where doc_id in (select doc_id from documents order by doc_id limit 50)"),
    "majority_baseline": with_(["preds"], """select doc_id, m as prediction, 1e0 as confidence, case when m=(select min(y_true) from preds) then 1e0 else 0e0 end as first_proba
        from preds, (select y_true as m from preds group by y_true order by count(*) desc, y_true limit 1)"""),
    "tfidf_vocabulary": with_tfidf(["vocab"], f"select term, idx, df, cf, {re_('idf', 6)} as idf from (select * replace(row_number() over (order by term)-1 as idx) from vocab)", **CLASSIFIER),
    "tfidf_features": with_tfidf(["weights"], f"select doc_id, term, {re_('weight', 6)} as weight from weights", **CLASSIFIER),
    "cluster_terms": with_tfidf(["weights"], f"""select lang as cluster_id, size, {re_('size*100e0/(select count(*) from documents)', 1)} as pct, coalesce(top_terms, '') as top_terms
        from (select lang, count(*) as size from documents group by lang) left join (select lang, string_agg(term, ', ' order by rn) as top_terms from (
        select lang, term, row_number() over (partition by lang order by round(sum(weight), 9) desc, term) as rn from weights join documents using (doc_id)
        group by lang, term) where rn<=15 group by lang) using (lang)""", **DISCOVERY),
    "brand_ranking": with_(["ranked", "pairs"], f"""select brand, outbound_tweets, inbound_msgs, conversations, usable_pairs, reply_rate, {re_('composite_score', 9)} as composite_score,
        coalesce(pairs, 0) as pairs, coalesce(threads, 0) as threads from ranked left join (select brand, count(*) as pairs, count(distinct conversation_id) as threads from pairs group by brand) p using (brand)"""),
}
