"""Queries over the driver's tables, each with SQL that gives the same rows where SQL can.

A query applies one or a few operators to whole tables. Versions of a table are made by a rule: the prior version is the table,
the current one leaves out keys divisible by 7 and raises amounts where a key is divisible by 5.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import patterns as P
from .functions import scalars as X
from .operators import audit as Q
from .operators import edits as E
from .operators import lookups as L
from .operators import placement as A
from .operators import reconcile as R
from .operators import sequences as S
from .sources import documents as D
from .sources import grids as G
from .sources import records as RS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str):
    return F.round(F.col(c) * 100).cast("bigint")


# ---------------------------------------------------------------- versions

ORDER_VERSIONS = """
with p as (select o_orderkey k, o_custkey c, o_orderpriority pr, cast(round(o_totalprice*100) as bigint) a from orders),
c as (select k, c, pr, a + case when k % 5 = 0 then 100 else 0 end a from p where k % 7 <> 0
      union all select k + 100000000, c, pr, a from p where k % 11 = 0)
"""


def order_versions(spark, sf_dir):
    p = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderpriority").alias("pr"), cents("o_totalprice").alias("a"))
    kept = p.where("k % 7 <> 0").withColumn("a", F.col("a") + F.when(F.col("k") % 5 == 0, 100).otherwise(0))
    new = p.where("k % 11 = 0").withColumn("k", F.col("k") + 100_000_000)
    return p.withColumn("rec_idx", F.col("k")), kept.unionByName(new).withColumn("rec_idx", F.col("k"))


@query(ORDER_VERSIONS + """
, j as (select case when c.k is null then 'dropped' when p.k is null then 'new' when p.a = c.a then 'continued' else 'modified' end status, p.a pa, c.a ca
  from p full join c on p.k = c.k and p.c = c.c and p.pr = c.pr)
select status, count(*) n, cast(coalesce(sum(pa),0) as bigint) prior_total, cast(coalesce(sum(ca),0) as bigint) current_total from j group by status""")
def version_status_counts(spark, sf_dir):
    p, c = order_versions(spark, sf_dir)
    return R.status_counts(R.compare_versions(p, c, ["k", "c", "pr"], amount="a"))


@query(ORDER_VERSIONS + """
select pr, cast(count(p.k) filter (p.k is not null) as bigint) prior_rows, count(c.k) filter (c.k is not null) current_rows
from p full join c using (k, c, pr) group by pr""")
def version_balance(spark, sf_dir):
    p, c = order_versions(spark, sf_dir)
    return R.in_out_balance(R.compare_versions(p, c, ["k", "c", "pr"], amount="a"), ["pr"])


LINE_VERSIONS = """
with l as (select l_orderkey o, l_linenumber n, cast(round(l_extendedprice*100) as bigint) a, l_partkey pk,
  row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) i from lineitem),
p as (select o, n, i, a from l),
c as (select o, n, i, a + case when pk % 5 = 0 then 100 else 0 end a from l where pk % 7 <> 0)
"""


#: More than the rows of one (l_orderkey, l_linenumber) can be, as row numbers are ints.
WIDE = 10**10


def shown_lines(compared: DataFrame) -> DataFrame:
    """Numbers as the SQL has them, which tell rows apart up to 9,999 of a key."""
    shown = lambda c: F.when(F.col(c) < 0, -1).otherwise(F.col("o") * 1_000_000 + F.col("n") * 10_000 + (F.col(c) % WIDE).cast("bigint")).cast("bigint").alias(c)
    return compared.select(shown("prior_idx"), shown("current_idx"), "status")


def line_versions(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    l = S.positions(l, ["l_orderkey", "l_linenumber"], order, "i")
    # digits of their own for each part, so that no two rows have one number
    step = F.lit(WIDE).cast("decimal(11,0)")
    of_key = (F.col("l_orderkey").cast("decimal(18,0)") * step).cast("decimal(28,0)") + F.col("l_linenumber")
    idx = (of_key.cast("decimal(28,0)") * step + F.col("i")).cast("decimal(38,0)").alias("rec_idx")
    p = l.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), "i", idx, cents("l_extendedprice").alias("a"), "l_partkey")
    c = p.where("l_partkey % 7 <> 0").withColumn("a", F.col("a") + F.when(F.col("l_partkey") % 5 == 0, 100).otherwise(0))
    return p.drop("l_partkey"), c.drop("l_partkey")


@query(LINE_VERSIONS + """
, pn as (select *, row_number() over (partition by o, n, a order by i) r from p), cn as (select *, row_number() over (partition by o, n, a order by i) r from c),
e as (select pn.o, pn.n, pn.i pi, cn.i ci, pn.a pa, cn.a ca from pn join cn on pn.o=cn.o and pn.n=cn.n and pn.a=cn.a and pn.r=cn.r),
pr as (select p.*, row_number() over (partition by p.o, p.n order by p.i) r from p where not exists (select 1 from e where e.o=p.o and e.n=p.n and e.pi=p.i)),
cr as (select c.*, row_number() over (partition by c.o, c.n order by c.i) r from c where not exists (select 1 from e where e.o=c.o and e.n=c.n and e.ci=c.i)),
m as (select o, n, pi, ci, pa, ca from e union all select pr.o, pr.n, pr.i, cr.i, pr.a, cr.a from pr join cr on pr.o=cr.o and pr.n=cr.n and pr.r=cr.r)
select o*1000000+n*10000+pi prior_idx, o*1000000+n*10000+ci current_idx, case when pa=ca then 'continued' else 'modified' end status from m
union all select o*1000000+n*10000+i, -1, 'dropped' from p where not exists (select 1 from m where m.o=p.o and m.n=p.n and m.pi=p.i)
union all select -1, o*1000000+n*10000+i, 'new' from c where not exists (select 1 from m where m.o=c.o and m.n=c.n and m.ci=c.i)""")
def reconcile_one_to_one(spark, sf_dir):
    p, c = line_versions(spark, sf_dir)
    return shown_lines(R.compare_versions(p, c, ["o", "n"], amount="a"))


@query(LINE_VERSIONS.replace("with l as", "with recursive l as") + """
, q as (select o, n, list(struct_pack(i := i, a := a) order by i) ps from p group by o, n), v as (select o, n, list(struct_pack(i := i, a := a) order by i) cs from c group by o, n),
s as (select q.o, q.n, ps, coalesce(cs, []) cs, 0 k, cast(null as bigint) pi, cast(null as bigint) ci, cast(null as bigint) pa, cast(null as bigint) ca from q left join v on q.o = v.o and q.n = v.n
  union all select o, n, ps, list_slice(cs, 1, w - 1) || list_slice(cs, w + 1, len(cs)), k + 1, ps[k+1].i, cs[w].i, ps[k+1].a, cs[w].a
  from (select *, case when list_position(list_transform(cs, lambda x: x.a), ps[k+1].a) > 0 then list_position(list_transform(cs, lambda x: x.a), ps[k+1].a) else 1 end w from s where k < len(ps))),
m as (select * from s where ci is not null)
select o*1000000+n*10000+pi prior_idx, o*1000000+n*10000+ci current_idx, case when pa=ca then 'continued' else 'modified' end status from m
union all select o*1000000+n*10000+i, -1, 'dropped' from p where not exists (select 1 from m where m.o=p.o and m.n=p.n and m.pi=p.i)
union all select -1, o*1000000+n*10000+i, 'new' from c where not exists (select 1 from m where m.o=c.o and m.n=c.n and m.ci=c.i)""")
def reconcile_greedy(spark, sf_dir):
    p, c = line_versions(spark, sf_dir)
    return shown_lines(R.compare_versions(p, c, ["o", "n"], amount="a", mode="greedy", gathered=True))


@query()
def reconcile_text(spark, sf_dir):
    """Documents of even ids against those of odd ids, among equal language, first word and number of words, by their whole texts; equal texts are one document."""
    words = F.split("text", r"\s+")
    d = table(spark, sf_dir, "documents").withColumns({"words": F.size(words), "first": F.get(words, F.lit(0)), "half": F.col("doc_id") % 2})
    d = d.groupBy("half", "lang", "words", "first", "text").agg(F.min("doc_id").alias("doc_id"))
    return R.match_by_text(d.where("half = 0"), d.where("half = 1"), ["lang", "words", "first"], idx="doc_id", text="text", head=None)


# ---------------------------------------------------------------- lookups

LOOKUP = """
with r as (select o_orderkey rec_idx, o_orderpriority agency, case when o_orderkey % 6 = 0 then '' else cast(o_custkey % 97 as varchar) end approp_id, cast(year(o_orderdate) as int) chapter_year,
  cast(floor(o_totalprice/1000) as bigint) approp_amount, cast(o_orderkey % 3 as bigint) reapprop_amount from orders),
t as (select o_orderkey row_idx, o_orderpriority agency, case when o_orderkey % 6 = 0 then '' else cast(o_custkey % 97 as varchar) end approp_id, cast(year(o_orderdate) as int) chapter_year,
  cast(floor(o_totalprice/1000) as bigint) approp_amount, cast(o_orderkey % 3 as bigint) reapprop_amount, case when o_orderkey % 10 = 1 then null else floor(o_totalprice/50) end balance from orders),
ti as (select * from t where approp_id <> ''),
k1 as (select agency, approp_id, chapter_year, approp_amount, (min(struct_pack(k := row_idx, v := balance))).v b from ti group by 1,2,3,4),
k2 as (select agency, approp_id, chapter_year, (min(struct_pack(k := row_idx, v := balance))).v b from ti group by 1,2,3),
k3 as (select agency, approp_id, approp_amount, (min(struct_pack(k := row_idx, v := balance))).v b from ti group by 1,2,3),
k4 as (select agency, approp_id, (min(struct_pack(k := row_idx, v := balance))).v b from ti group by 1,2),
n1 as (select agency, chapter_year, approp_amount, reapprop_amount, (min(struct_pack(k := row_idx, v := balance))).v b from t group by 1,2,3,4),
n2 as (select agency, chapter_year, approp_amount, (min(struct_pack(k := row_idx, v := balance))).v b from t group by 1,2,3),
j as (select r.rec_idx, r.approp_id <> '' has_id, k1.b b1, k2.b b2, k3.b b3, k4.b b4, n1.b m1, n2.b m2 from r
  left join k1 on r.agency=k1.agency and r.approp_id=k1.approp_id and r.chapter_year=k1.chapter_year and r.approp_amount=k1.approp_amount
  left join k2 on r.agency=k2.agency and r.approp_id=k2.approp_id and r.chapter_year=k2.chapter_year
  left join k3 on r.agency=k3.agency and r.approp_id=k3.approp_id and r.approp_amount=k3.approp_amount
  left join k4 on r.agency=k4.agency and r.approp_id=k4.approp_id
  left join n1 on r.agency=n1.agency and r.chapter_year=n1.chapter_year and r.approp_amount=n1.approp_amount and r.reapprop_amount=n1.reapprop_amount
  left join n2 on r.agency=n2.agency and r.chapter_year=n2.chapter_year and r.approp_amount=n2.approp_amount),
o as (select rec_idx, case when has_id then coalesce(b1,b2,b3,b4) else coalesce(m1,m2) end balance,
  case when has_id then case when b1 is not null then 'agency+id+chyr+amt' when b2 is not null then 'agency+id+chyr' when b3 is not null then 'agency+id+amt' when b4 is not null then 'agency+id_only' else '' end
  else case when m1 is not null then 'agency+noid+chyr+amt+re' when m2 is not null then 'agency+noid+chyr+amt' else '' end end as method from j)
"""


def balances(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    base = [F.col("o_orderpriority").alias("agency"), F.when(F.col("o_orderkey") % 6 == 0, "").otherwise((F.col("o_custkey") % 97).cast("string")).alias("approp_id"), F.year("o_orderdate").alias("chapter_year"), F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("approp_amount"), (F.col("o_orderkey") % 3).alias("reapprop_amount")]
    rows = o.select(F.col("o_orderkey").alias("rec_idx"), F.lit("dropped").alias("status"), *base)
    balance = F.when(F.col("o_orderkey") % 10 == 1, None).otherwise(F.floor(F.col("o_totalprice") / 50)).cast("double").alias("balance")
    return rows, o.select(F.col("o_orderkey").alias("row_idx"), *base, balance)


@query(LOOKUP + """
select rec_idx, cast(balance as double) balance, method, case when balance > 0 then cast(ceil(balance/1000)*1000 as bigint) else 0 end rounded, coalesce(balance >= 1000, false) insert_eligible from o""")
def lookup_cascade(spark, sf_dir):
    return L.attach_balance(*balances(spark, sf_dir)).select("rec_idx", "balance", "method", "rounded", "insert_eligible")


@query(LOOKUP + """
select count(*) n, count(balance) matched, count(*) - count(balance) unmatched, count(*) filter (balance = 0) zero, count(*) filter (balance > 0 and balance < 1000) small,
count(*) filter (balance >= 1000) eligible, cast(coalesce(sum(ceil(balance/1000)*1000) filter (balance >= 1000),0) as bigint) rounded_total from o""")
def lookup_summary(spark, sf_dir):
    return L.balance_summary(L.attach_balance(*balances(spark, sf_dir)))


@query(LOOKUP + """
select rec_idx, cast(balance as double) balance, method, case when balance > 0 then cast(ceil(balance/1000)*1000 as bigint) else 0 end rounded, coalesce(balance >= 1000, false) insert_eligible from o""")
def lookup_cascade_all(spark, sf_dir):
    return L.attach_balance(*balances(spark, sf_dir)).select("rec_idx", "balance", "method", "rounded", "insert_eligible")


@query(LOOKUP + """
select count(*) n, count(balance) matched, count(*) - count(balance) unmatched, count(*) filter (balance = 0) zero, count(*) filter (balance > 0 and balance < 1000) small,
count(*) filter (balance >= 1000) eligible, cast(coalesce(sum(ceil(balance/1000)*1000) filter (balance >= 1000),0) as bigint) rounded_total from o""")
def lookup_summary_all(spark, sf_dir):
    return L.balance_summary(L.attach_balance(*balances(spark, sf_dir)))


@query(LOOKUP + "select rec_idx, agency, approp_id, chapter_year, approp_amount from r where rec_idx in (select rec_idx from o where balance is null) order by rec_idx limit 15")
def unmatched_sample(spark, sf_dir):
    """The report of records without a balance shows 15 of them."""
    rows = L.attach_balance(*balances(spark, sf_dir))
    return L.unmatched_sample(rows, ["rec_idx"]).select("rec_idx", "agency", "approp_id", "chapter_year", "approp_amount")


@query("""
with s as (select cast(s_nationkey as varchar) agency, s_suppkey id, cast(floor(s_acctbal) as bigint) balance from supplier where s_acctbal > 5000), c as (select cast(c_nationkey as varchar) agency, c_custkey id, cast(floor(c_acctbal) as bigint) balance from customer)
select agency, id, balance from s union all select agency, id, balance from c where agency not in (select agency from s)""")
def lookup_source_priority(spark, sf_dir):
    """Nations whose suppliers have large balances use those, the others fall back on their customers."""
    rows = lambda name, c: table(spark, sf_dir, name).select(F.col(f"{c}_nationkey").cast("string").alias("agency"), F.col("s_suppkey" if c == "s" else "c_custkey").alias("id"), F.floor(f"{c}_acctbal").cast("bigint").alias("balance"), F.col(f"{c}_acctbal").alias("__a"))
    return L.preferred([rows("supplier", "s").where("__a > 5000").drop("__a"), rows("customer", "c").drop("__a")], ["agency"])


LEARNED = """
with k as (select c_mktsegment agency, o_orderkey id, cast(year(o_orderdate) as int) y, cast(round(o_totalprice) as bigint) a from orders join customer on o_custkey=c_custkey),
c as (select cast(c_nationkey % 7 as varchar) code, o_orderkey id, cast(year(o_orderdate) as int) y, cast(round(o_totalprice) as bigint) a from orders join customer on o_custkey=c_custkey),
v as (select agency, code, count(*) n, count(*) filter (a >= 400000) big from k join c using (id, y, a) group by 1,2),
w as (select *, max(big) over (partition by agency) > 0 bb from v),
x as (select agency, code, bb, case when bb then big else n end v from w),
r as (select *, row_number() over (partition by agency order by v desc, code) rn from x where v > 0),
b as (select code, max(agency) agency from r where rn=1 and bb group by code),
s as (select code, min(agency) agency from r where rn=1 and not bb and code not in (select code from b) group by code),
m as (select * from b union all select * from s)
select cast(c_nationkey % 7 as varchar) code, coalesce(m.agency, '') agency, count(*) n from customer left join m on cast(c_nationkey % 7 as varchar) = m.code group by 1,2"""


@query(LEARNED)
def learned_mapping(spark, sf_dir):
    return mapping_of(spark, sf_dir)


@query(LEARNED)
def learned_mapping_all(spark, sf_dir):
    return mapping_of(spark, sf_dir)


def mapping_of(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    j = table(spark, sf_dir, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey"))
    on = [F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("y"), F.round("o_totalprice").cast("bigint").alias("a")]
    code = (F.col("c_nationkey") % 7).cast("string").alias("code")
    m = L.learned_mapping(j.select(code, *on), j.select(F.col("c_mktsegment").alias("agency"), *on), ["id", "y", "a"], "code", "agency", "a", large=400_000)
    return L.apply_mapping(cust.select(code), m, "code", "agency").groupBy("code", "agency").agg(F.count("*").alias("n"))


@query("""
with e as (select source, lang, count(*) expected from documents group by 1,2), a as (select source, lang, count(*) actual from documents join labels using (doc_id) where quality=1 group by 1,2)
select source, lang, cast(coalesce(expected,0) as bigint) expected, cast(coalesce(actual,0) as bigint) actual, cast(coalesce(actual,0)-coalesce(expected,0) as bigint) delta from e full join a using (source, lang)""")
def expected_vs_actual(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", X.fund_name(F.concat(F.lit("; "), F.col("source"), F.lit(" ;"))).alias("source"))
    good = table(spark, sf_dir, "labels").where("quality = 1")
    count = lambda df: df.groupBy("source", "lang").agg(F.count("*").alias("n"))
    return L.expected_and_actual(count(d), count(d.join(good, "doc_id")), ["source", "lang"], "n")


@query("""
select c_custkey, not exists (select 1 from orders where o_custkey=c_custkey and o_orderstatus='P') no_pending, not exists (select 1 from orders where o_custkey=c_custkey) no_order from customer""")
def existence_flags(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    return L.missing_in(L.missing_in(c, o.where("o_orderstatus = 'P'"), ["c_custkey"], "no_pending"), o, ["c_custkey"], "no_order")


# ---------------------------------------------------------------- sequences

EVENTS = ["user_id"], ["ts", "event_id"]


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


@query("""
select event_id, last_value(case when event_type='signup' then event_id end ignore nulls) over w program, last_value(case when event_type='error' then value end ignore nulls) over w fund
from events window w as (partition by user_id order by ts, event_id rows unbounded preceding)""")
def context_carry(spark, sf_dir):
    t = F.col("event_type")
    return S.carry_forward(events(spark, sf_dir), {"program": F.when(t == "signup", F.col("event_id")), "fund": F.when(t == "error", F.col("value"))}, *EVENTS).select("event_id", "program", "fund")


@query("""
with e as (select *, sum(case when event_type='signup' then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) epoch from events)
select event_id, cast(epoch as bigint) epoch, last_value(case when event_type='error' then event_id end ignore nulls) over (partition by user_id, epoch order by ts, event_id rows unbounded preceding) fund from e""")
def epoch_reset(spark, sf_dir):
    t = F.col("event_type")
    e = S.epochs(events(spark, sf_dir), t == "signup", *EVENTS)
    return S.carry_forward(e, {"fund": F.when(t == "error", F.col("event_id"))}, ["user_id", "epoch"], EVENTS[1]).select("event_id", "epoch", "fund")


@query("""
with e as (select *, cast(ts as date) d from events), h as (select user_id, d, arg_max(event_id, event_id) filter (event_type='error') last_error from e group by 1,2)
select user_id, d, last_error from h""")
def last_header_of_page(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("d", F.to_date("ts"))
    return S.last_per_page(e, F.when(F.col("event_type") == "error", F.col("event_id")), ["user_id", "d"], "event_id", "last_error")


SEGMENTS = """
with e as (select *, sum(case when event_type='signup' then 1 else 0 end) over w + coalesce(sum(case when event_type='purchase' then 1 else 0 end) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding),0) segment
  from events window w as (partition by user_id order by ts, event_id rows unbounded preceding)),
s as (select *, max(case when event_type='purchase' then 1 else 0 end) over (partition by user_id, segment) = 1 closed from e)
"""


def event_segments(spark, sf_dir):
    t = F.col("event_type")
    return S.segments(events(spark, sf_dir), t == "signup", t == "purchase", *EVENTS)


@query(SEGMENTS + "select event_id, cast(segment as bigint) segment, closed from s")
def record_segments(spark, sf_dir):
    return event_segments(spark, sf_dir).select("event_id", "segment", "closed")


@query(SEGMENTS + """
select user_id, cast(segment as bigint) segment, arg_min(event_id, (ts, event_id)) first_event, arg_max(event_id, (ts, event_id)) last_event, count(*) n,
string_agg(lpad(cast(user_id % 100 as varchar), 2, ' ') || ' ' || event_type, chr(10) order by ts, event_id) body from s where closed and event_type <> 'signup' group by 1,2""")
def record_assembly(spark, sf_dir):
    rows = event_segments(spark, sf_dir).where("closed and event_type <> 'signup'").withColumn("line", X.numbered(F.col("user_id") % 100, F.col("event_type")))
    at = F.struct("ts", "event_id")
    out = rows.groupBy("user_id", "segment").agg(F.min_by("event_id", at).alias("first_event"), F.max_by("event_id", at).alias("last_event"), F.count("*").alias("n"))
    return out.join(RS.joined_text(rows, ["user_id", "segment"], ["ts", "event_id"], "line").withColumnRenamed("text", "body"), ["user_id", "segment"])


@query("""
with e as (select *, case when event_type='view' then 1 when event_type='error' then 0 end ev from events),
f as (select *, last_value(ev ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) nw, last_value(ev ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) was from e)
select event_id, coalesce(nw = 1 or (event_type='error' and was = 1), false) excluded from f""")
def excluded_spans(spark, sf_dir):
    t = F.col("event_type")
    return S.excluded_spans(events(spark, sf_dir), t == "view", t == "error", *EVENTS).select("event_id", "excluded")


@query("""
with l as (select doc_id, unnest(string_split(text, chr(10))) t, generate_subscripts(string_split(text, chr(10)), 1) - 1 n from documents),
m as (select *, length(t) i, min(length(t)) over (partition by doc_id order by n rows between unbounded preceding and 1 preceding) b from l),
p as (select *, sum(case when b is null or i <= b then 1 else 0 end) over (partition by doc_id order by n rows unbounded preceding) part_no from m)
select doc_id, cast(part_no as bigint) part_no, count(*) lines, cast(min(n) as bigint) first_line from p group by 1,2""")
def header_wrap_parts(spark, sf_dir):
    lines = D.text_lines(table(spark, sf_dir, "documents"))
    parts = S.wrapped_parts(lines, F.length("raw_text"), ["doc_id"], ["global_p_idx"])
    return parts.groupBy("doc_id", "part_no").agg(F.count("*").alias("lines"), F.min("global_p_idx").cast("bigint").alias("first_line"))


@query("""select o_orderkey, row_number() over (partition by o_custkey order by case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end, o_orderdate, o_orderkey) as position from orders""")
def doc_position(spark, sf_dir):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return S.positions(table(spark, sf_dir, "orders").withColumn("rank", rank), ["o_custkey"], ["rank", "o_orderdate", "o_orderkey"]).select("o_orderkey", F.col("position").cast("bigint").alias("position"))


ORDER_RUN = ["o_custkey"], ["o_orderdate", "o_orderkey"]


@query("""
with o as (select *, o_orderstatus='F' s from orders), c as (select *, case when lag(s) over w is not distinct from s and lag(o_orderpriority) over w is not distinct from o_orderpriority and row_number() over w > 1 then 0 else 1 end ch from o window w as (partition by o_custkey order by o_orderdate, o_orderkey)),
r as (select *, sum(ch) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding) run from c)
select o_orderkey, dense_rank() over (partition by o_custkey order by run) group_no from r where s""")
def survivor_groups(spark, sf_dir):
    return S.groups_of(table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F", ["o_orderpriority"], *ORDER_RUN).select("o_orderkey", F.col("group_no").cast("bigint").alias("group_no"))


@query("""
select o_orderkey, last_value(case when o_orderstatus='O' then o_orderkey end ignore nulls) over (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding) previous_anchor,
first_value(case when o_orderstatus='O' then o_orderkey end ignore nulls) over (partition by o_custkey order by o_orderdate, o_orderkey rows between 1 following and unbounded following) next_anchor from orders""")
def anchor_gaps(spark, sf_dir):
    return S.neighbours(table(spark, sf_dir, "orders"), F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey")), *ORDER_RUN).select("o_orderkey", "previous_anchor", "next_anchor")


@query("""
with f as (select l_partkey, l_returnflag, min((l_shipdate, l_orderkey)) p from lineitem group by 1,2)
select l_partkey, l_returnflag, epoch(p[1])::bigint shipped, p[2] l_orderkey from f""")
def first_positions(spark, sf_dir):
    f = S.first_positions(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_returnflag"], ["l_shipdate", "l_orderkey"])
    return f.select("l_partkey", "l_returnflag", F.unix_timestamp("l_shipdate").alias("shipped"), "l_orderkey")


@query("""
with f as (select l_suppkey, l_partkey, min((l_shipdate, l_orderkey)) p from lineitem group by 1,2)
select l_suppkey, l_partkey, row_number() over (partition by l_suppkey order by p, l_partkey) as rank from f""")
def distinct_in_order(spark, sf_dir):
    return S.distinct_in_order(table(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_partkey"], ["l_shipdate", "l_orderkey"]).select("l_suppkey", "l_partkey", F.col("rank").cast("bigint").alias("rank"))


@query("""
with c as (select *, case when lag(o_orderpriority) over w is not distinct from o_orderpriority and row_number() over w > 1 then 0 else 1 end ch from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)),
r as (select *, sum(ch) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding) run from c)
select o_orderkey, last_value(case when o_orderstatus='O' then o_orderkey end ignore nulls) over (partition by o_custkey, run order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding) previous from r""")
def prev_match_in_run(spark, sf_dir):
    return S.previous_in_run(table(spark, sf_dir, "orders"), F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey")), ["o_orderpriority"], *ORDER_RUN, "previous").select("o_orderkey", "previous")


@query("""
with b as (select o_custkey c, year(o_orderdate) y, month(o_orderdate) m, max(o_orderkey) k from orders where o_orderkey % 3 = 0 group by 1,2,3),
r as (select o_orderkey, o_custkey, year(o_orderdate) y, month(o_orderdate) m from orders where o_orderkey % 3 <> 0)
select r.o_orderkey, cast(x.y as int) newer_y, cast(x.m as int) newer_m, x.k newer_k from r left join lateral (select y, m, k from b where b.c=r.o_custkey and (b.y, b.m) > (r.y, r.m) order by y, m limit 1) x on true""")
def asof_newer_block(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    blocks = o.where("o_orderkey % 3 = 0").groupBy("o_custkey", "y", "m").agg(F.max("o_orderkey").alias("k"))
    return S.nearest_newer(o.where("o_orderkey % 3 <> 0"), blocks, ["o_custkey"], ["y", "m"], ["k"]).select("o_orderkey", "newer_y", "newer_m", "newer_k")


@query("""
with r as (select p_brand, p_partkey, row_number() over (partition by p_brand order by p_partkey) rk, p_partkey in (select l_partkey from lineitem where l_quantity > 49) ex from part)
select p_brand, p_partkey, ex as "exists", first_value(case when ex then p_partkey end ignore nulls) over (partition by p_brand order by rk rows between 1 following and unbounded following) next_key from r""")
def next_existing_group(spark, sf_dir):
    ranked = S.positions(table(spark, sf_dir, "part").select("p_brand", "p_partkey"), ["p_brand"], ["p_partkey"], "rank")
    there = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return S.next_existing(ranked, there, ["p_brand"], "p_partkey").select("p_brand", "p_partkey", "exists", "next_key")


LETTERS = " ".join(f"when k < {sum(26**i for i in range(1, n + 1))} then " + " || ".join(f"chr(cast(65 + (k - {sum(26**i for i in range(1, n))}) // {26**p} % 26 as int))" for p in range(n - 1, -1, -1)) for n in range(1, 8))


@query(f"""
with l as (select l_orderkey % 50 page, l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() over (partition by l_orderkey % 50 order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 k from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, page || case {LETTERS} end as label from l""")
def page_labels(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumn("page", F.col("l_orderkey") % 50)
    return S.page_labels(l, ["page"], F.col("page"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "label")


@query(f"""
with l as (select l_orderkey % 50 page, l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() over (partition by l_orderkey % 50 order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 k from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, page || case {LETTERS} end as label from l""")
def page_labels_all(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumn("page", F.col("l_orderkey") % 50)
    return S.long_page_labels(l, ["page"], F.col("page"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "label")


# ---------------------------------------------------------------- placement

@query("""
with s as (select o_orderkey k, o_custkey c, o_orderpriority pr, year(o_orderdate) y, o_orderstatus st from orders),
r1 as (select c, pr, min(k) v from s where k % 2 = 0 and st='O' group by 1,2), r2 as (select c, y, min(k) v from s where st='P' group by 1,2), r3 as (select c, min(k) v from s where st='O' group by 1)
select s.k, case when r1.v is not null then 'continued_same_fund' when r2.v is not null then 'chyr_header' when r3.v is not null then 'fund_header' else 'doc_start' end kind,
cast(coalesce(r1.v, r2.v, r3.v, 0) as int) page, cast(case when r1.v is not null then 7 when coalesce(r2.v, r3.v) is not null then greatest(s.y - 1995, 0) else 0 end as int) line
from s left join r1 using (c, pr) left join r2 using (c, y) left join r3 using (c) where st='F'""")
def anchor_cascade(spark, sf_dir):
    s = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderpriority").alias("pr"), F.year("o_orderdate").alias("y"), F.col("o_orderstatus").alias("st"))
    rule = lambda df, keys, name: S.first_positions(df, keys, ["k"]).withColumnRenamed("k", name)
    out = s.where("st = 'F'").join(rule(s.where("k % 2 = 0 and st = 'O'"), ["c", "pr"], "r1"), ["c", "pr"], "left").join(rule(s.where("st = 'P'"), ["c", "y"], "r2"), ["c", "y"], "left").join(rule(s.where("st = 'O'"), ["c"], "r3"), ["c"], "left")
    line = A.line_before(F.col("y") - 1994)
    anchor = A.cascade([("continued_same_fund", F.col("r1"), F.lit(7)), ("chyr_header", F.col("r2"), line), ("fund_header", F.col("r3"), line)])
    return out.select("k", anchor.alias("a")).select("k", "a.*")


ANCHORS = """
with p as (select o_custkey // 10 d, o_orderpriority pr, o_orderstatus f, cast(year(o_orderdate) as int) y, o_orderkey k, row_number() over (partition by o_custkey // 10 order by o_orderpriority, o_orderstatus, year(o_orderdate) * (1 - 2 * (o_custkey // 10 % 2)), o_orderkey) pos from orders),
c as (select *, 100 * ((cp - 1) // 10) + (cp - 1) % 10 + 1 v from (select *, row_number() over (partition by d order by pos) cp from p
  where k % 3 <> 0 and not (d % 3 = 0 and pr like '3%') and not (d % 5 = 2 and pr >= '4') and not (f = 'O' and (d + y) % 2 = 0) and not (f = 'F' and d % 7 < 3) and not (y = 1996 and k % 2 = 0))),
e as (select d, pr, f, y, min(v) a, max(v) z from c group by 1, 2, 3, 4), fu as (select d, pr, f, min(v) v from c group by 1, 2, 3), g as (select d, pr, min(v) v from c group by 1, 2),
w as (select p.*, c.k is null gone, last_value(c.v ignore nulls) over (partition by p.d, p.pr, p.f order by p.pos rows between unbounded preceding and 1 preceding) r1 from p left join c on p.k = c.k),
r as (select w.*, (select a from e where e.d = w.d and e.pr = w.pr and e.f = w.f and e.y = w.y) r2, (select arg_min(z, y) from e where e.d = w.d and e.pr = w.pr and e.f = w.f and e.y > w.y) r3,
  (select arg_min(v, f) from fu where fu.d = w.d and fu.pr = w.pr and fu.f > w.f) r4, (select v from fu where fu.d = w.d and fu.pr = w.pr and fu.f = w.f) r5,
  (select v from g where g.d = w.d and g.pr = w.pr) r6, (select arg_min(v, pr) from g where g.d = w.d and g.pr > w.pr) r7 from w where gone),
x as (select k, case when r1 is not null then 'continued_same_fund' when r2 is not null then 'chyr_header' when r3 is not null then 'after_newer_chyr' when r5 is null and r4 is not null then 'before_next_fund'
  when r5 is not null then 'fund_header' when r6 is not null then 'program_header' when r7 is not null then 'before_next_program' else 'doc_start' end kind,
  coalesce(r1, r2, r3, case when r5 is null then r4 end, r5, r6, r7, 0) v from r)
"""


def anchored(spark, sf_dir):
    """Orders as records of documents of ten customers each, with the newest year first in every other one; a second version drops parts of most."""
    o = table(spark, sf_dir, "orders").select(F.floor(F.col("o_custkey") / 10).alias("d"), F.lit("reapprop").alias("source"), F.col("o_orderpriority").alias("program"), F.col("o_orderstatus").alias("fund"), F.year("o_orderdate").alias("chapter_year"), F.lit(0).alias("amending_year"), F.col("o_orderkey").alias("rec_idx"))
    prior = S.positions(o, ["d"], ["program", "fund", F.col("chapter_year") * (1 - 2 * (F.col("d") % 2)), "rec_idx"])
    k, d, y, pr, f = (F.col(c) for c in ("rec_idx", "d", "chapter_year", "program", "fund"))
    left_out = (k % 3 == 0) | ((d % 3 == 0) & pr.startswith("3")) | ((d % 5 == 2) & (pr >= "4")) | ((f == "O") & ((d + y) % 2 == 0)) | ((f == "F") & (d % 7 < 3)) | ((y == 1996) & (k % 2 == 0))
    current = S.positions(prior.where(~left_out), ["d"], ["position"], "n")
    page, line = F.floor((F.col("n") - 1) / 10).cast("int"), ((F.col("n") - 1) % 10 + 1).cast("int")
    current = current.select("d", "source", "program", "fund", "chapter_year", "amending_year", "rec_idx", page.alias("first_page"), line.alias("first_line"), page.alias("last_page"), line.alias("last_line"))
    matches = current.select(F.col("rec_idx").alias("prior_idx"), F.col("rec_idx").alias("current_idx"))
    dropped = prior.join(current.select("rec_idx"), "rec_idx", "left_anti")
    return A.anchors(dropped, prior, current, matches, ["d"], ["program", "fund"], ["chapter_year", "amending_year"])


@query(ANCHORS + "select k, kind, cast(v // 100 as int) page, cast(case when kind in ('continued_same_fund', 'after_newer_chyr', 'doc_start') then v % 100 else greatest(v % 100 - 1, 0) end as int) line from x")
def anchor_rules(spark, sf_dir):
    """All eight rules, each of which fires."""
    return anchored(spark, sf_dir).select(F.col("rec_idx").alias("k"), "anchor.*")


@query(ANCHORS + "select kind, count(*) n from x group by 1")
def anchor_rule_counts(spark, sf_dir):
    return anchored(spark, sf_dir).groupBy(F.col("anchor.kind").alias("kind")).agg(F.count("*").alias("n"))


@query("""
with o as (select o_orderkey, cast(o_custkey % 40 as int) first_page, cast(o_orderkey % 40 as int) - 1 chyr_page, cast(o_orderkey % 23 as int) - 1 fund_page, o_orderstatus='F' nc, o_orderpriority like '1%' nf from orders)
select o_orderkey, least(first_page, case when nc and chyr_page between 0 and first_page-1 then chyr_page else first_page end, case when nf and fund_page between 0 and first_page-1 then fund_page else first_page end) start_page from o""")
def range_widen(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 40).cast("int").alias("first_page"), ((F.col("o_orderkey") % 40).cast("int") - 1).alias("chyr_page"), ((F.col("o_orderkey") % 23).cast("int") - 1).alias("fund_page"),
        (F.col("o_orderstatus") == "F").alias("needs_chapter_header"), F.col("o_orderpriority").startswith("1").alias("needs_fund_header"),
    )
    return A.widened(o).select("o_orderkey", "start_page")


@query("""
with s as (select l_suppkey, l_orderkey, cast(round(l_extendedprice) as bigint) a, year(l_shipdate) y from lineitem)
select l_suppkey || '' as label, count(*) n, cast(sum(a) as bigint) total, list_sort(list_distinct(list(cast(y as int)))) as years from s group by 1""")
def nested_plan(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem")
    one = F.struct("l_orderkey", "l_linenumber", F.round("l_extendedprice").cast("bigint").alias("new_amount"), F.year("l_shipdate").alias("chapter_year"))
    plan = s.groupBy(F.col("l_suppkey").cast("string").alias("label")).agg(F.array_sort(F.collect_list(one)).alias("survivors"))
    return Q.brief(plan)


@query("""
with c as (select k % 100 page, count(*) n from (select o_orderkey k from orders) group by 1) select page, n from c order by n desc, page limit 10""")
def top_and_sample(spark, sf_dir):
    pages = table(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % 100).alias("page")).agg(F.count("*").alias("n"))
    return pages.orderBy(F.desc("n"), "page").limit(10)


@query("""
with s as (select o_orderkey, cast(round(o_totalprice) as bigint) a from orders where o_orderstatus='F'), r as (select count(*) n from s where a < 1000)
select * from (values ('survivor placed once', 0), ('every survivor placed', (select n from r)), ('only survivors placed', 0), ('labels unique', 0), ('amounts balance', (select case when n > 0 then 1 else 0 end from r))) t("rule", violations)""")
def plan_invariants(spark, sf_dir):
    """A plan that leaves out small amounts, so that two of the rules must notice."""
    s = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", F.round("o_totalprice").cast("bigint").alias("a"))
    placed = s.where("a >= 1000")
    labels = S.page_labels(placed, ["o_custkey"], F.col("o_custkey"), ["o_orderkey"])
    return A.invariants(s, labels, placed, "o_orderkey", ["label"], "a")


@query("""
with o as (select o_orderkey k, o_custkey c, o_orderstatus st from orders), r as (select c, min(k) v from o where st='O' group by 1)
select k, 'no anchor in the current version' reason from o left join r using (c) where st='F' and v is null""")
def rejects_and_reasons(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("st"))
    r = S.first_positions(o.where("st = 'O'"), ["c"], ["k"]).withColumnRenamed("k", "v")
    placed = o.where("st = 'F'").join(r, "c", "left").withColumn("anchor", A.cascade([("fund_header", F.col("v"), F.lit(0))]))
    return RS.rejects(placed.withColumn("anchor_kind", F.col("anchor.kind"))).select("k", "reason")


# ---------------------------------------------------------------- documents, lines and edits

DOC_LINES = """
with l as (select doc_id, unnest(string_split(text, chr(10))) raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 n from documents),
d as (select doc_id, n, cast(n // 20 as int) pg, cast(n % 20 as int) ix, cast(n % 20 as int) + 1 ln, raw, trim(raw) = '' blank from l)
"""


def doc_lines(spark, sf_dir):
    """Document lines on pages of 20, each numbered by its place on the page."""
    lines = D.text_lines(table(spark, sf_dir, "documents"), page_size=20)
    return lines.withColumn("line_num", (F.col("p_idx") + 1).cast("int"))


@query(DOC_LINES + "select doc_id, pg page_idx, ix p_idx, n global_p_idx, length(raw) n_chars, blank is_blank from d")
def doc_line_table(spark, sf_dir):
    d = doc_lines(spark, sf_dir)
    return d.select("doc_id", F.col("page_idx").cast("int").alias("page_idx"), F.col("p_idx").cast("int").alias("p_idx"), F.col("global_p_idx").cast("bigint").alias("global_p_idx"), F.length("raw_text").cast("bigint").alias("n_chars"), "is_blank")


@query("""
with p as (select page_id, regexp_extract_all(html, '(?is)<p\\b[^>]*>(.*?)</p>', 1) a from pages), u as (select page_id, unnest(a) t, generate_subscripts(a, 1) - 1 i from p),
x as (select page_id, i, replace(replace(replace(replace(replace(replace(replace(regexp_replace(t, '<[^>]*>', '', 'g'), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&amp;', '&') t from u)
select page_id, count(*) n, cast(sum(length(t)) as bigint) chars, arg_max(md5(t), i) last from x group by 1""")
def page_paragraphs(spark, sf_dir):
    p = D.paragraphs(table(spark, sf_dir, "pages"), "page_id", "html")
    return p.groupBy("page_id").agg(F.count("*").alias("n"), F.sum(F.length("raw_text")).alias("chars"), F.max_by(F.md5("raw_text"), "p_idx").alias("last"))


@query(DOC_LINES + """
, k as (select doc_id, n, case when blank then 'blank' when not regexp_matches(raw, '^\\s{0,3}\\d{1,3}\\s+') then 'header' else 'body' end kind from d)
select doc_id, count(*) n_lines, count(*) filter (kind='blank') n_blank, count(*) filter (kind='header') n_header, count(*) filter (kind='body') n_body from k group by 1""")
def line_counts(spark, sf_dir):
    return D.line_counts(D.text_lines(table(spark, sf_dir, "documents")))


@query("""
select p_partkey, regexp_extract(p_brand, '(\\d+)', 1) code, cast(floor(p_retailprice) as bigint) amount, cast(ceil(p_retailprice/1000)*1000 as bigint) rounded, '(re. $' || format('{:,}', cast(floor(p_retailprice) as bigint)) || ')' carried,
cast(p_size as varchar) id, p_type || ' ..... ' || format('{:,}', cast(floor(p_retailprice) as bigint)) line from part""")
def pattern_extract(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    amount = F.floor("p_retailprice").cast("bigint")
    line = F.concat("p_type", F.lit(" ..... "), F.format_number(amount, 0))
    return p.select(
        "p_partkey", P.capture(F.col("p_brand"), r"(\d+)").alias("code"), P.amount(P.capture(line, P.END_AMOUNT)).alias("amount"), X.round_up(F.col("p_retailprice")).alias("rounded"),
        X.carried(E.carried_amount(X.carried(amount))).alias("carried"), X.plain_id(F.concat(F.col("p_size").cast("string"), F.lit(".0"))).alias("id"), line.alias("line"),
    )


@query(DOC_LINES + "select doc_id, count(*) n, cast(sum(length(raw)) as bigint) chars from d where pg between 1 and 2 group by 1")
def page_slice(spark, sf_dir):
    d = D.page_slice(doc_lines(spark, sf_dir), 1, 2)
    return d.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("raw_text")).cast("bigint").alias("chars"))


@query("select n_name as name, count(*) customers, 3 n_lines, 1 first_page from nation join customer on n_nationkey = c_nationkey group by 1")
def document_scan(spark, sf_dir):
    """A paged document for each nation is written to a folder as a file of its own, then the folder is read."""
    from .sources.stages import shared_path

    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "customer"), F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))
    html = F.concat(F.lit('<div class="page"><p>AGENCY</p><p>  1  '), "n_name", F.lit("</p><p>  2  "), F.col("n").cast("string"), F.lit("</p></div>"))
    at = shared_path(spark)
    rows.select(html.alias("value")).write.option("maxRecordsPerFile", 1).text(at)
    docs = D.scan(spark, at)
    lines = D.paged_lines(docs).join(docs.select("doc_id", D.first_page_of(F.col("file_name")).alias("first_page")), "doc_id")
    value = lambda n: F.max(F.when(F.col("line_num") == n, F.col("text")))
    out = lines.groupBy("doc_id").agg(value(1).alias("name"), value(2).cast("bigint").alias("customers"), F.count("*").alias("n_lines"), F.min("first_page").alias("first_page"))
    return out.drop("doc_id")


KEPT = DOC_LINES + """
, s as (select doc_id, min(n) f, min(n) + quality * 25 + toxic * 30 l, case when toxic=1 then 'appropriation' else 'reapprop' end src, 1000 + doc_id oa, 2000 + doc_id na from (select doc_id, 3 + doc_id % 9 n, quality, toxic from labels) group by doc_id, quality, toxic),
r as (select doc_id, cast(f//20 as int) fp, cast(f%20 as int)+1 fl, cast(l//20 as int) lp, cast(l%20 as int)+1 ll, src, oa, na from s),
k as (select d.*, r.src, r.oa, r.na, r.doc_id is not null and (d.pg, d.ln) >= (r.fp, r.fl) and (d.pg, d.ln) <= (r.lp, r.ll) keep, d.pg = r.lp and d.ln = r.ll last from d left join r using (doc_id))
"""


def kept_ranges(spark, sf_dir):
    lb = table(spark, sf_dir, "labels").withColumn("f", 3 + F.col("doc_id") % 9).withColumn("l", F.col("f") + F.col("quality") * 25 + F.col("toxic") * 30)
    place = lambda c: [F.floor(F.col(c) / 20).cast("int"), (F.col(c) % 20 + 1).cast("int")]
    (fp, fl), (lp, ll) = place("f"), place("l")
    return lb.select("doc_id", fp.alias("first_page"), fl.alias("first_line"), lp.alias("last_page"), ll.alias("last_line"), F.when(F.col("toxic") == 1, "appropriation").otherwise("reapprop").alias("source"), (1000 + F.col("doc_id")).alias("old_amount"), (2000 + F.col("doc_id")).alias("new_amount"))


@query(KEPT + "select doc_id, pg page_idx, ln line_num from k where keep")
def keep_lines(spark, sf_dir):
    return E.kept_lines(doc_lines(spark, sf_dir), kept_ranges(spark, sf_dir), ["doc_id"]).select("doc_id", F.col("page_idx").cast("int").alias("page_idx"), "line_num")


def scripted(spark, sf_dir):
    """The edit script; lines on a survivor's last place end in the amount that it replaces."""
    lines, ranges = doc_lines(spark, sf_dir), kept_ranges(spark, sf_dir)
    amount = ranges.where("source = 'reapprop'").select("doc_id", F.col("last_page").alias("page_idx"), F.col("last_line").alias("line_num"), X.carried(F.col("old_amount")).alias("__a"))
    lines = lines.join(amount, ["doc_id", "page_idx", "line_num"], "left").withColumn("raw_text", F.when(F.col("__a").isNotNull() & ~F.col("is_blank"), F.concat("raw_text", F.lit(" "), "__a")).otherwise(F.col("raw_text"))).drop("__a")
    return E.edit_script(lines, ranges, ["doc_id"])


SCRIPT = KEPT + """
, t as (select *, coalesce(keep, false) kp, coalesce(last, false) lst, case when not blank and coalesce(last, false) and src='reapprop' then raw || ' (re. $' || format('{:,}', oa) || ')' else raw end old from k),
e as (select *, case when blank then 'blank' when not kp then 'strike' when lst and src='appropriation' then 'append' when lst and src='reapprop' then 'replace' else 'keep' end op,
 case when blank then old when not kp then null when lst and src='appropriation' then old || ' ... (re. $' || format('{:,}', na) || ')' when lst and src='reapprop' then raw || ' (re. $' || format('{:,}', na) || ')' else old end nw from t)
"""


@query(SCRIPT + "select doc_id, pg page_idx, ix p_idx, op, md5(old) old, md5(nw) new from e")
def edit_script(spark, sf_dir):
    return scripted(spark, sf_dir).select("doc_id", F.col("page_idx").cast("int").alias("page_idx"), F.col("p_idx").cast("int").alias("p_idx"), "op", F.md5("old").alias("old"), F.md5("new").alias("new"))


@query(SCRIPT + "select doc_id, md5(string_agg(nw, chr(10) order by n)) text from e where nw is not null group by 1")
def edited_text(spark, sf_dir):
    s = scripted(spark, sf_dir).where("new is not null")
    return RS.joined_text(s, ["doc_id"], ["global_p_idx"], "new").select("doc_id", F.md5("text").alias("text"))


@query(SCRIPT + """
select doc_id, pg page_idx, ix p_idx, md5(case op when 'strike' then '~~' || old || '~~' when 'replace' then '~~' || old || '~~++' || nw || '++' when 'append' then old || '++ ... (re. $' || format('{:,}', na) || ')++' else old end) diff from e""")
def inline_diff(spark, sf_dir):
    return scripted(spark, sf_dir).select("doc_id", F.col("page_idx").cast("int").alias("page_idx"), F.col("p_idx").cast("int").alias("p_idx"), F.md5(E.inline_diff()).alias("diff"))


@query(SCRIPT + "select doc_id, count(distinct pg) pages, count(*) filter (op in ('strike','replace')) deletions, count(*) filter (op in ('replace','append')) insertions from e group by 1")
def edit_summary(spark, sf_dir):
    return E.change_counts(scripted(spark, sf_dir), ["doc_id"])


@query(SCRIPT + """
, f as (select doc_id, min((pg, ln)) v from e where op in ('keep','replace','append') group by 1), b as (select e.doc_id, e.pg, max(e.ix) ix from e join f using (doc_id) where e.pg = f.v[1] and e.ln < f.v[2] and not blank group by 1,2)
select doc_id, pg page_idx, ix p_idx, 'L' || doc_id as label from b""")
def insert_labels(spark, sf_dir):
    s = scripted(spark, sf_dir)
    labels = kept_ranges(spark, sf_dir).select("doc_id", F.concat(F.lit("L"), F.col("doc_id")).alias("label"))
    return E.labels_before_kept(s, labels, ["doc_id"]).select("doc_id", F.col("page_idx").cast("int").alias("page_idx"), F.col("p_idx").cast("int").alias("p_idx"), "label")


@query(DOC_LINES + """
, t as (select doc_id, cast(doc_id % 3 as int) pg, cast(doc_id % 31 as int) line from documents)
select t.doc_id, t.pg page_idx, t.line, cast(case when t.line = 0 then 0 else coalesce(min(d.ix) filter (d.ln = t.line), max(d.ix) filter (d.ln <= t.line), -1) end as int) p_idx from t left join d on t.doc_id=d.doc_id and t.pg=d.pg group by 1,2,3""")
def locate_lines(spark, sf_dir):
    targets = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 3).cast("int").alias("page_idx"), (F.col("doc_id") % 31).cast("int").alias("line"))
    return E.located(doc_lines(spark, sf_dir), targets, ["doc_id"]).select("doc_id", "page_idx", "line", F.col("p_idx").cast("int").alias("p_idx"))


@query(DOC_LINES + """
, h as (select *, contains(raw, 'the') has, sum(case when contains(raw, 'the') then 1 else 0 end) over (partition by doc_id, pg order by ix rows unbounded preceding) r from d)
select doc_id, pg page_idx, ix p_idx, md5(left(raw, instr(raw, 'the') - 1) || 'THE' || substr(raw, instr(raw, 'the') + 3)) new_text from h where has and r = 2""")
def find_and_replace_nth(spark, sf_dir):
    d = E.find_text(E.replace_nth(doc_lines(spark, sf_dir), "the", "THE", 1, ["doc_id", "page_idx"]), "the").where("new_text <> raw_text")
    return d.select("doc_id", F.col("page_idx").cast("int").alias("page_idx"), F.col("p_idx").cast("int").alias("p_idx"), F.md5("new_text").alias("new_text"))


@query(DOC_LINES + "select doc_id, count(*) n, 1 ids from d where pg = 0 and ix between 2 and 9 and not blank group by 1")
def bulk_delete(spark, sf_dir):
    return E.bulk_delete(doc_lines(spark, sf_dir), ["doc_id"], 0, 2, 9).groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("change_id").cast("int").alias("ids"))


@query(DOC_LINES + """
, h as (select doc_id, n, raw, length(raw) < 40 and not blank hd, blank from d), c as (select *, last_value(case when hd then n end ignore nulls) over (partition by doc_id order by n rows unbounded preceding) hn from h),
s as (select doc_id, n from d where n > 0 and n % 11 = 0), f as (select s.doc_id, s.n start, c.hn header from s join c on c.doc_id=s.doc_id and c.n = s.n - 1 where c.hn is not null),
o as (select c.*, row_number() over (partition by doc_id, hn order by n) nth from c where hn is not null)
select f.doc_id, f.start, f.header, o.n line_at from f join o on o.doc_id=f.doc_id and o.hn=f.header and o.nth <= 2 and o.n < f.start""")
def nearest_headers(spark, sf_dir):
    d = doc_lines(spark, sf_dir).withColumn("global_p_idx", F.col("global_p_idx").cast("bigint"))
    starts = d.where("global_p_idx > 0 and global_p_idx % 11 = 0").select("doc_id", "global_p_idx")
    return E.headers_before(d, starts, (F.length("raw_text") < 40) & ~F.col("is_blank"), ["doc_id"], 2).select("doc_id", "start", "header", "line_at")


AUDIT = SCRIPT + """
, g as (select *, case when blank then 'blank' when op='keep' then 'keep' when op='strike' then 'struck' else 'edit' end kind from e),
b as (select *, kind in ('keep','edit') st, kind in ('keep','edit') and (contains(old, '(re.') or regexp_matches(old, '\\([0-9]{5}\\)')) mk from g where kind <> 'blank'),
c as (select *, case when lag(st) over w = st then 0 else 1 end ch, row_number() over w as pos from b window w as (partition by doc_id order by n)),
rn as (select *, sum(ch) over (partition by doc_id order by n rows unbounded preceding) run from c),
y as (select *, st and max(case when mk then 1 else 0 end) over (partition by doc_id, run order by n rows between current row and unbounded following) = 1 body from rn),
z as (select doc_id, min(pos) filter (body) lo, max(pos) filter (body) hi from y group by 1),
sb as (select y.doc_id, coalesce(bool_or(not y.st and y.pos > lo and y.pos < hi), false) f from y join z using (doc_id) group by 1)
"""


def audited(spark, sf_dir):
    return scripted(spark, sf_dir).withColumn("kind", Q.line_kind())


@query(AUDIT + "select kind, count(*) n from g group by 1")
def line_kinds(spark, sf_dir):
    return Q.kind_counts(audited(spark, sf_dir))


@query(AUDIT + "select doc_id, f struck_between_kept from sb")
def struck_between_kept(spark, sf_dir):
    return Q.struck_between(audited(spark, sf_dir), ["doc_id"], ["global_p_idx"])


FLAGS = AUDIT + """
, fl as (select g.doc_id, list_filter([case when bool_or(kind in ('keep','edit') and contains(lower(old), 'total of sub-schedule')) then 'subschedule-in-kept' end, case when any_value(sb.f) then 'struck-between-kept' end,
  case when not bool_or(kind in ('keep','edit')) then 'empty-insert' end, case when not bool_or(kind='struck') then 'no-strikes' end], lambda x: x is not null) tags from g left join sb using (doc_id) group by 1)
"""


@query(FLAGS + "select doc_id, tags from fl")
def audit_flags(spark, sf_dir):
    return Q.flags(audited(spark, sf_dir), ["doc_id"], ["global_p_idx"])


@query(AUDIT + """
, fl as (select g.doc_id, list_filter([case when bool_or(kind in ('keep','edit') and contains(lower(old), 'total of sub-schedule')) then 'subschedule-in-kept' end, case when bool_or(kind in ('keep','edit') and regexp_matches(old, '^\\s*-{5,}')) then 'separator-in-kept' end,
  case when any_value(sb.f) then 'struck-between-kept' end, case when not bool_or(kind in ('keep','edit')) then 'empty-insert' end, case when not bool_or(kind='struck') then 'no-strikes' end,
  case when doc_id % 3 = 0 then 'missing-chyr-header' end, case when doc_id % 4 = 0 then 'missing-fund-header' end], lambda x: x is not null) tags from g left join sb using (doc_id) group by 1)
select doc_id, tags from fl""")
def audit_flags_all(spark, sf_dir):
    """All seven tags; every third document would need a chapter header and every fourth a fund header, which none of these texts has."""
    needs = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 3 == 0).alias("needs_chapter_header"), (F.col("doc_id") % 4 == 0).alias("needs_fund_header"))
    return Q.flags(audited(spark, sf_dir), ["doc_id"], ["global_p_idx"], needs)


@query(FLAGS + "select tag, count(*) n, list_sort(list(doc_id)) labels from (select doc_id, unnest(tags) tag from fl) group by 1")
def flag_summary(spark, sf_dir):
    return Q.flag_summary(audit_flags(spark, sf_dir), "doc_id")


@query("""select doc_id, ['no-html'] tags from labels where doc_id not in (select doc_id from documents where n_chars > 1000)""")
def plan_without_lines(spark, sf_dir):
    plan = table(spark, sf_dir, "labels").select("doc_id")
    return Q.without_lines(plan, table(spark, sf_dir, "documents").where("n_chars > 1000"), ["doc_id"])


@query("""select doc_id, ['no-html'] tags from labels where doc_id not in (select doc_id from documents where n_chars > 1000)""")
def plan_without_lines_all(spark, sf_dir):
    plan = table(spark, sf_dir, "labels").select("doc_id")
    return Q.without_lines(plan, table(spark, sf_dir, "documents").where("n_chars > 1000"), ["doc_id"])


@query("""
select * from (values ('amount is positive', (select count(*) from orders where not o_totalprice > 0)), ('has lines', (select count(*) from orders where o_orderkey not in (select l_orderkey from lineitem))),
('status is known', (select count(*) from orders where o_orderstatus not in ('F','O'))), ('quality is 0 or 1', (select count(*) from labels where quality not in (0,1)))) t("rule", violations)""")
def quality_violations(spark, sf_dir):
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return Q.violations({
        "amount is positive": (o, F.col("o_totalprice") > 0), "has lines": (L.missing_in(o, l, ["o_orderkey"], "none"), ~F.col("none")),
        "status is known": (o, F.col("o_orderstatus").isin("F", "O")), "quality is 0 or 1": (table(spark, sf_dir, "labels"), F.col("quality").isin(0, 1)),
    })


@query(DOC_LINES + """
, t as (select doc_id, 'L' || (doc_id % 7) as label, cast(doc_id % 3 as int) pg, cast(doc_id % 31 as int) line from documents union all select doc_id, 'M', cast(doc_id % 3 as int), cast(doc_id % 31 as int) from documents where doc_id % 5 = 0),
x as (select t.doc_id, t.label, t.pg, case when t.line = 0 then 0 else coalesce(min(d.ix) filter (d.ln = t.line), max(d.ix) filter (d.ln <= t.line), -1) end ix from t left join d on t.doc_id=d.doc_id and t.pg=d.pg group by t.doc_id, t.label, t.pg, t.line),
u as (select doc_id, pg, ix, '' as label, raw txt from d union all select doc_id, pg, ix, label, 'Insert ' || label from x where ix >= 0)
select doc_id, md5(string_agg(txt, chr(10) order by pg, ix, label)) as text from u group by 1""")
def tracker_text(spark, sf_dir):
    """Labels behind the lines that they are anchored to; two labels of one line in the order of their texts."""
    d, lines = table(spark, sf_dir, "documents"), doc_lines(spark, sf_dir)
    at = [(F.col("doc_id") % 3).cast("int").alias("page_idx"), (F.col("doc_id") % 31).cast("int").alias("line")]
    labels = d.select("doc_id", F.concat(F.lit("L"), F.col("doc_id") % 7).alias("label"), *at).unionByName(d.where("doc_id % 5 = 0").select("doc_id", F.lit("M").alias("label"), *at))
    placed = E.located(lines, labels, ["doc_id"]).where("p_idx >= 0")
    text = E.with_inserts(lines, placed, ["doc_id"], F.col("raw_text"))
    return RS.joined_text(text, ["doc_id"], ["page_idx", "p_idx", "label"], "text").select("doc_id", F.md5("text").alias("text"))


@query("""
select label, n from (select 'first' || '' as part, l as label, n from (select cast(l_suppkey as varchar) l, count(*) n from lineitem group by 1) order by l limit 5)
union all select label, n from (select cast(l_suppkey as varchar) as label, count(*) n from lineitem group by 1) where label in ('7', '9')""")
def run_selection(spark, sf_dir):
    plan = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("label")).agg(F.count("*").alias("n"))
    return E.chosen(plan, first=5).unionByName(E.chosen(plan, labels=["7", "9"]))


@query("select count(*) n, count(distinct c_mktsegment) agencies, count(distinct c_nationkey) codes, count(*) filter (c_acctbal < 0) negative from customer")
def lookup_distinct_counts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.agg(F.count("*").alias("n"), F.count_distinct("c_mktsegment").alias("agencies"), F.count_distinct("c_nationkey").alias("codes"), F.count_if(F.col("c_acctbal") < 0).alias("negative"))


# ---------------------------------------------------------------- sources and sinks

@query("""
with p as (select s_nationkey doc, s_suppkey k, s_name nm, 'appropriation' source, 0 part from supplier union all select c_nationkey, c_custkey, c_name, 'reapprop', 1 from customer)
select doc, k, source, row_number() over (partition by doc order by part, k) - 1 rec_idx from p""")
def union_provenance(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("doc"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("nm"))
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("doc"), F.col("c_custkey").alias("k"), F.col("c_name").alias("nm"))
    out = RS.with_provenance({"appropriation": s, "reapprop": c}, ["k"], ["doc"])
    return out.withColumn("rank", RS.source_rank(F.col("source"))).where("rank is not null").select("doc", "k", "source", "rec_idx")


@query("select doc_id, cast(regexp_extract('part pg' || (doc_id % 90 + 1) || '-450.html', 'pg(\\d+)-(\\d+)', 1) as int) first_page, 1 missing from documents")
def source_offsets(spark, sf_dir):
    name = F.concat(F.lit("part pg"), F.col("doc_id") % 90 + 1, F.lit("-450.html"))
    return table(spark, sf_dir, "documents").select("doc_id", D.first_page_of(name).alias("first_page"), D.first_page_of(F.lit("plain.html")).alias("missing"))


GRID = """
with c as (select cast(c_nationkey % 3 as int) sheet_no, c_custkey, row_number() over (partition by c_nationkey % 3 order by c_custkey) + 3 r, c_mktsegment seg, c_nationkey nk, cast(floor(c_acctbal) as bigint) bal from customer)
"""


def customer_grid(spark, sf_dir, composite: bool):
    """Three sheets of customers under four rows of heads; the first sheet has no balance, so the second one must be chosen."""
    c = table(spark, sf_dir, "customer").withColumn("sheet_no", (F.col("c_nationkey") % 3).cast("int"))
    c = S.positions(c, ["sheet_no"], ["c_custkey"], "r").withColumn("row", F.col("r") + 3)
    bal, year = F.floor("c_acctbal").cast("bigint").cast("string"), (2000 + F.col("c_nationkey") % 20).cast("string")
    key = F.concat_ws("|", "c_mktsegment", F.col("c_custkey").cast("string"), year, bal)
    cells = [key, F.lit("x"), bal] if composite else [F.concat(F.lit("A"), year, F.lit("02")), F.concat(F.col("c_custkey").cast("string"), F.lit(" - Name")), F.lit("skip"), F.concat(F.col("c_nationkey").cast("string"), F.lit(" - Dept")), F.lit("0"), bal, bal]
    heads = ["Composite_Key", "note", "Undisbursed  Appropriation Balance"] if composite else ["Budget Reference", "Budgetary Program", "Budgetary Program Level 2", "Budgetary Department", "Original Approp Amount", "Current Appropriation", "Undisbursed Balance"]
    numeric = [h.startswith(("Und", "Ori", "Cur")) for h in heads]
    data = c.select(F.concat(F.lit("s"), F.col("sheet_no")).alias("sheet"), "sheet_no", F.col("row").cast("int").alias("row"), F.array(*cells).alias("cells"), F.lit(numeric).alias("is_number"))
    sheets = c.select("sheet_no").distinct()
    head = sheets.select(F.concat(F.lit("s"), F.col("sheet_no")).alias("sheet"), "sheet_no", F.lit(2).alias("row"), F.array(*[F.when(F.col("sheet_no") > 0, h).otherwise(F.lit("other")) for h in heads]).alias("cells"), F.lit([False] * len(heads)).alias("is_number"))
    return data.unionByName(head)


@query("""
select 's' || s as sheet, s sheet_no, cast(null as int) composite, cast(case when s > 0 then 6 end as int) balance, cast(case when s > 0 then 0 end as int) bud_ref, cast(case when s > 0 then 1 end as int) bud_prog, cast(case when s > 0 then 3 end as int) bud_dept,
cast(case when s > 0 then 4 end as int) orig_amt, cast(case when s > 0 then 5 end as int) curr_amt from (select distinct cast(c_nationkey % 3 as int) s from customer)""")
def grid_header_discovery(spark, sf_dir):
    return G.find_columns(customer_grid(spark, sf_dir, False))


@query(GRID + """, s as (select min(r) m from c where sheet_no=1 and bal <> 0 and r < 20)
select cast(nk as varchar) dept_code, cast(c_custkey as varchar) approp_id, cast(2000 + nk % 20 as int) chapter_year, bal approp_amount, cast(bal as double) balance, r row_idx from c, s where sheet_no = 1 and r >= coalesce(m, 12)""")
def load_raw_grid(spark, sf_dir):
    return G.load_raw(customer_grid(spark, sf_dir, False)).drop("reapprop_amount")


@query(GRID + """, s as (select min(r) m from c where sheet_no=1 and bal <> 0 and r < 20)
select seg agency, cast(c_custkey as varchar) approp_id, cast(2000 + nk % 20 as int) chapter_year, bal approp_amount, cast(bal as double) balance, r row_idx from c, s where sheet_no = 1 and r >= coalesce(m, 12)""")
def load_composite_grid(spark, sf_dir):
    return G.load_composite(customer_grid(spark, sf_dir, True)).drop("reapprop_amount")


def customer_books(spark, sf_dir):
    """Four books of customers: one with composite keys, two with plain columns in different orders, one that can't be loaded."""
    c = table(spark, sf_dir, "customer").withColumn("b", F.col("c_nationkey") % 4)
    c = S.positions(c, ["b"], ["c_custkey"], "r").withColumn("row", (F.col("r") + 3).cast("int"))
    bal, year = F.floor("c_acctbal").cast("bigint").cast("string"), (2000 + F.col("c_nationkey") % 20).cast("string")
    plain = {
        "Budget Reference": F.concat(F.lit("A"), year, F.lit("02")), "Budgetary Program": F.concat(F.col("c_custkey").cast("string"), F.lit(" - Name")), "Budgetary Department": F.concat(F.col("c_nationkey").cast("string"), F.lit(" - Dept")),
        "Original Approp Amount": F.lit("0"), "Current Appropriation": bal, "Undisbursed Balance": bal,
    }
    books = [
        {"note": F.lit("x"), "Undisbursed Appropriation Balance": bal, "Composite_Key": F.concat_ws("|", "c_mktsegment", F.col("c_custkey").cast("string"), year, bal)}, plain, dict(reversed(plain.items())),
        {k: v for k, v in plain.items() if not k.startswith("Und")},
    ]
    out = None
    for n, cells in enumerate(books):
        name, heads = F.lit(f"book{n}").alias("book"), list(cells)
        at = lambda row, values, numeric: (name, F.lit("data").alias("sheet"), F.lit(1).alias("sheet_no"), row.alias("row"), F.array(*values).alias("cells"), F.lit(numeric).alias("is_number"))
        data = c.where(F.col("b") == n).select(*at(F.col("row"), cells.values(), [h.startswith(("Und", "Ori", "Cur")) for h in heads]))
        head = spark.range(1).select(*at(F.lit(2), map(F.lit, heads), [False] * len(heads)))
        cover = spark.range(1).select(name, F.lit("cover").alias("sheet"), F.lit(0).alias("sheet_no"), F.lit(0).alias("row"), F.array(F.lit("contents")).alias("cells"), F.array(F.lit(False)).alias("is_number"))
        for part in (data, head, cover):
            out = part if out is None else out.unionByName(part)
    return out


BOOKS = """
with c as (select cast(c_nationkey % 4 as int) b, c_custkey, row_number() over (partition by c_nationkey % 4 order by c_custkey) + 3 r, c_mktsegment seg, c_nationkey nk, cast(floor(c_acctbal) as bigint) bal from customer),
s as (select b, coalesce(min(r) filter (bal <> 0 and r < 20), 12) m from c group by 1)
"""


@query(BOOKS + """
select 'book' || c.b book, case when c.b = 0 then 'composite' else 'raw' end as mode, case when c.b = 0 then seg end agency, case when c.b > 0 then cast(nk as varchar) end dept_code, cast(c_custkey as varchar) approp_id, cast(2000 + nk % 20 as int) chapter_year,
bal approp_amount, cast(0 as bigint) reapprop_amount, cast(bal as double) balance, r row_idx from c join s using (b) where c.b < 3 and r >= m""")
def load_books(spark, sf_dir):
    return G.load_books(customer_books(spark, sf_dir))


@query("select 'book3' book, 2 sheets, 'no sheet has the columns that are needed' reason")
def unfit_books(spark, sf_dir):
    return G.unfit_books(customer_books(spark, sf_dir))


@query("select c_mktsegment agency, c_custkey approp_id, c_acctbal balance from customer where c_mktsegment='BUILDING'")
def load_legacy_lookup(spark, sf_dir):
    names = {"c_mktsegment": "agency", "c_custkey": "approp_id", "c_acctbal": "balance"}
    return G.load_legacy(table(spark, sf_dir, "customer").select(*names), names, "BUILDING")


@query(DOC_LINES + "select doc_id, pg page_idx, ix p_idx, n global_p_idx, md5(raw) raw from d")
def malformed_pages(spark, sf_dir):
    """Documents as malformed pages, read back line by line."""
    from .plans.render import malformed_pages as rendered

    pages = rendered(doc_lines(spark, sf_dir), "doc_id")
    docs = pages.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_idx", "html"))), lambda x: x["html"]), "").alias("html"))
    lines = D.paged_lines(docs)
    return lines.select("doc_id", "page_idx", "p_idx", F.col("global_p_idx").cast("bigint").alias("global_p_idx"), F.md5("raw_text").alias("raw"))


@query(DOC_LINES + "select doc_id, pg page, ix p_idx, md5(raw) raw from d")
def paged_files(spark, sf_dir):
    """The same pages written to files of many pages each, read in parts. A page's first paragraph says whose it is."""
    from .plans.render import malformed_pages as rendered
    from .sources.stages import shared_path

    pages = rendered(doc_lines(spark, sf_dir), "doc_id")
    named = F.replace("html", F.lit("'sheet page'>"), F.concat(F.lit("'sheet page'><p>"), F.col("doc_id").cast("string"), F.lit(" "), F.col("page_idx").cast("string")))
    at = shared_path(spark)
    pages.select(named.alias("value")).write.text(at)
    lines = D.file_lines(spark, at)
    heads = lines.where("p_idx = 0").select(F.col("doc_id").alias("file"), "page_idx", F.split("raw_text", " ").alias("h"))
    rows = lines.where("p_idx > 0").withColumnRenamed("doc_id", "file").join(heads, ["file", "page_idx"])
    return rows.select(F.get("h", F.lit(0)).cast("bigint").alias("doc_id"), F.get("h", F.lit(1)).cast("int").alias("page"), (F.col("p_idx") - 1).cast("int").alias("p_idx"), F.md5("raw_text").alias("raw"))


# ---------------------------------------------------------------- bills: rendered from orders, read back by the extraction

from .plans import extract as EX  # noqa: E402
from .plans import placing as PL  # noqa: E402
from .plans import render as RD  # noqa: E402

ITEMS = """
with i as (select 'bill' || c_nationkey || '-' || (c_custkey // 1000) doc_id, upper(c_mktsegment) || ' PROGRAM' program, case o_orderstatus when 'F' then 'General Fund' when 'O' then 'Special Revenue Funds - Other' when 'P' then 'Enterprise Funds' else 'Fiduciary Funds' end fund,
cast(year(o_orderdate) as int) chapter_year, lpad(cast(o_orderkey % 100000 as varchar), 5, '0') approp_id, cast(round(o_totalprice) as bigint) amount, o_orderkey k from orders join customer on o_custkey=c_custkey)
"""


def items(spark, sf_dir):
    return RD.items_of(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def bill_lines(bill: DataFrame) -> DataFrame:
    """A rendered bill's lines, staged, as the extraction reads them more than once."""
    from .sources.stages import passing

    with passing(bill.sparkSession) as keep:
        return keep(D.paged_lines(bill))


RECORD_COLS = ["doc_id", "agency", "program", "fund", "chapter_year", "amending_year", "approp_id", "approp_amount", "reapprop_amount"]


@query(ITEMS + "select doc_id, 'EDUCATION DEPARTMENT' agency, program, fund, chapter_year, 0 amending_year, approp_id, amount approp_amount, amount reapprop_amount from i")
def bill_reapprops(spark, sf_dir):
    return EX.carried_records(bill_lines(RD.reapprop_bill(items(spark, sf_dir)))).select(RECORD_COLS)


@query(ITEMS + """
select doc_id, program, fund || '; Local Government Records Management Fund; Account of the Fund - 20501' fund, chapter_year, chapter_year + 1 amending_year, approp_id, amount approp_amount, amount reapprop_amount from i""")
def bill_multiline_headers(spark, sf_dir):
    """Funds of three parts, one of them wrapped, chapter headers over three lines, and sub-schedules between records."""
    lines = bill_lines(RD.reapprop_bill(items(spark, sf_dir), long_headers=True, subschedules=True))
    return EX.carried_records(lines).select([c for c in RECORD_COLS if c != "agency"])


@query(ITEMS + "select doc_id, 'EDUCATION DEPARTMENT' agency, program, fund, 2025 chapter_year, 0 amending_year, approp_id, amount approp_amount, amount reapprop_amount from i")
def bill_appropriations(spark, sf_dir):
    return EX.new_records(bill_lines(RD.approp_bill(items(spark, sf_dir)))).select(RECORD_COLS)


@query(ITEMS + """
, o as (select *, row_number() over (partition by doc_id order by program, fund, chapter_year desc, k) r from i),
f as (select *, coalesce(lag(program) over w <> program, true) np, coalesce(lag(fund) over w <> fund or lag(program) over w <> program, true) nf, coalesce(lag(chapter_year) over w <> chapter_year or lag(fund) over w <> fund or lag(program) over w <> program, true) nc from o window w as (partition by doc_id order by r)),
n as (select *, 2 + cast(np as int) + cast(nf as int) + cast(nc as int) c, sum(2 + cast(np as int) + cast(nf as int) + cast(nc as int)) over (partition by doc_id order by r rows unbounded preceding) - (2 + cast(np as int) + cast(nf as int) + cast(nc as int)) s from f),
h as (select doc_id, program, cast(null as varchar) fund, s pos from n where np union all select doc_id, program, fund, s + cast(np as int) from n where nf)
select doc_id, program, fund, cast(min(pos) // 50 as int) page, cast(min(pos) % 50 + 1 as int) line from h group by 1,2,3""")
def bill_header_positions(spark, sf_dir):
    h = EX.header_positions(bill_lines(RD.reapprop_bill(items(spark, sf_dir))))
    return h.select("doc_id", "program", "fund", F.col("page").cast("int").alias("page"), F.col("line").cast("int").alias("line"))


@query(ITEMS + "select doc_id, count(*) n from i where program = 'BUILDING PROGRAM' group by 1")
def bill_warnings(spark, sf_dir):
    """Records without a chapter year: those of the program whose chapter headers are left out."""
    r = EX.without_chapter(EX.carried_records(bill_lines(RD.reapprop_bill(items(spark, sf_dir), bare_program="BUILDING PROGRAM"))))
    return r.groupBy("doc_id").agg(F.count("*").alias("n"))


def bill_plan_and_lines(spark, sf_dir, long_headers=False, lines=True):
    """Two rendered versions of all bills, extracted, compared, given balances and placed, staged; and the prior version's lines, if they are wanted. Each stage goes as soon as what is made of it is staged."""
    from .sources.stages import passing

    i = items(spark, sf_dir)
    number = lambda df: df.withColumn("rec_idx", F.col("approp_id").cast("bigint") * 10_000_000_000_000 + F.pmod(F.xxhash64(*RECORD_COLS), F.lit(10_000_000_000_000)))
    before = bill_lines(RD.reapprop_bill(i, long_headers)) if lines else None
    with passing(spark) as keep:
        with passing(spark) as records:
            prior = records(number(EX.carried_records(before if lines else bill_lines(RD.reapprop_bill(i, long_headers)))))
        with passing(spark) as records:
            later = bill_lines(RD.reapprop_bill(i.where("k % 7 <> 0 and (k % 3 <> 0 or fund <> 'General Fund')"), long_headers))
            current, heads = EX.carried_records_and_headers(later)
            current, heads = records(number(current)), records(heads)
        balances = i.where("k % 10 <> 3").select(F.lit("EDUCATION DEPARTMENT").alias("agency"), "approp_id", "chapter_year", F.col("amount").alias("approp_amount"), F.col("amount").alias("reapprop_amount"), F.col("amount").cast("double").alias("balance"), F.col("k").alias("row_idx"))
        plan = PL.plan(prior, current, balances, fund_headers=heads.where("fund is not null"), program_headers=heads.where("fund is null").drop("fund"))
        return keep(plan), before


def bill_plan(spark, sf_dir):
    return bill_plan_and_lines(spark, sf_dir, lines=False)[0]


@query(ITEMS + """
, d as (select * from i where k % 7 = 0 or (k % 3 = 0 and fund = 'General Fund')), s as (select * from d where k % 10 <> 3 and amount >= 1000)
select doc_id, program, fund, count(*) survivors, cast(sum(cast(ceil(amount / 1000.0) * 1000 as bigint)) as bigint) total from s group by 1,2,3""")
def bill_versions_to_plan(spark, sf_dir):
    return PL.summary(bill_plan(spark, sf_dir), ["doc_id", "program", "fund"], F.col("rounded")).drop("labels")


@query(ITEMS + """
, d as (select * from i where k % 7 = 0 or (k % 3 = 0 and fund = 'General Fund')), s as (select *, cast(ceil(amount / 1000.0) * 1000 as bigint) rounded from d where k % 10 <> 3 and amount >= 1000)
select doc_id, count(*) ids, count(*) filter (rounded <> amount) replaced, cast(sum(rounded) filter (rounded <> amount) as bigint) new_total, 0 bad_labels from s group by 1""")
def bill_edits(spark, sf_dir):
    """From the plan to edited lines, with their labels placed: every survivor's line stays, its amount is the rounded balance."""
    from .sources.stages import passing

    with passing(spark) as keep:
        p, lines = bill_plan_and_lines(spark, sf_dir)
        script = keep(PL.edits(p, lines).select("doc_id", "label", "page_idx", "global_p_idx", "line_num", "raw_text", "text", "is_blank", "op", "new"))
        p = keep(p.groupBy("doc_id", "label").agg(F.bool_or("needs_chapter_header").alias("needs_chapter_header"), F.bool_or("needs_fund_header").alias("needs_fund_header")))
    stays, replaced = F.col("op").isin("keep", "replace"), F.col("op") == "replace"
    out = script.groupBy("doc_id").agg(F.count_if(stays & F.col("new").rlike(r"\([0-9]{5}\)")).alias("ids"), F.count_if(replaced).alias("replaced"), F.sum(F.when(replaced, E.carried_amount(F.col("new")))).alias("new_total"))
    # a label must stand before the first line that is kept
    flags = Q.flags(script.withColumn("kind", Q.line_kind()), ["doc_id", "label"], ["global_p_idx"], p)
    bad = flags.where("arrays_overlap(tags, array('empty-insert', 'missing-chyr-header', 'missing-fund-header'))").groupBy("doc_id").agg(F.count("*").alias("bad_labels"))
    return out.join(bad, "doc_id", "left").fillna(0, ["bad_labels"])


@query(ITEMS + """
, c as (select * from i where k % 7 <> 0 and (k % 3 <> 0 or fund <> 'General Fund')), s as (select * from i where (k % 7 = 0 or (k % 3 = 0 and fund = 'General Fund')) and k % 10 <> 3 and amount >= 1000),
f as (select distinct doc_id, program, fund from s where not exists (select 1 from c where c.doc_id = s.doc_id and c.program = s.program and c.fund = s.fund)),
h as (select distinct doc_id, program, fund, chapter_year from s where not exists (select 1 from c where c.doc_id = s.doc_id and c.program = s.program and c.fund = s.fund and c.chapter_year = s.chapter_year)),
x as (select doc_id, count(*) n from f group by 1), y as (select doc_id, count(*) n from h group by 1), d as (select distinct doc_id from s)
select doc_id, coalesce(x.n, 0) funds, coalesce(x.n, 0) fund_parts, coalesce(x.n, 0) fund_wraps, 0 fund_rest, coalesce(y.n, 0) chapters, coalesce(y.n, 0) chapter_second, 0 chapter_rest from d left join x using (doc_id) left join y using (doc_id)""")
def bill_edits_long_headers(spark, sf_dir):
    """Header lines that the edits of a plan keep, of bills whose funds have four lines and whose chapter headers have three: three and two of them, each once."""
    from .sources.stages import passing

    with passing(spark) as keep:
        p, lines = bill_plan_and_lines(spark, sf_dir, long_headers=True)
        script = keep(PL.edits(p, lines).where("op = 'keep'").select("doc_id", "page_idx", "line_num", "text").distinct())
    t = F.col("text")
    kinds = {
        "funds": P.is_fund_family(t), "fund_parts": t == "Local Government Records", "fund_wraps": t == "Management Fund", "fund_rest": t.startswith("Account of the Fund"),
        "chapters": t.startswith("The appropriation made by"), "chapter_second": t.startswith("supplemented by"), "chapter_rest": t.startswith("as amended by"),
    }
    return script.groupBy("doc_id").agg(*[F.count_if(c).alias(name) for name, c in kinds.items()])


@query(ITEMS + """
, d as (select * from i where k % 7 = 0 or (k % 3 = 0 and fund = 'General Fund')), s as (select * from d where k % 10 <> 3 and amount >= 1000)
select doc_id, program, fund, count(*) survivors, cast(sum(cast(ceil(amount / 1000.0) * 1000 as bigint)) as bigint) total, cast(sum(amount) as bigint) old_total, 0 large_parts, 0 struck, 0 unknown_rules from s group by 1,2,3""")
def bill_plan_nested(spark, sf_dir):
    """The nested plan in parts of at most 50 survivors, written as JSON, read with its types and laid flat again."""
    from .sources.stages import shared_path

    p = PL.nested(bill_plan(spark, sf_dir), ["doc_id"], most=50)
    at = shared_path(spark)
    RS.write_json(p, at)
    back = RS.read_json(spark, at, p.schema)
    rows = PL.flat(back.withColumn("size", F.size("survivors")).withColumn("n_struck", F.size("struck_non_survivors")))
    out = rows.groupBy("doc_id", "program", "fund").agg(
        F.count("*").alias("survivors"), F.sum("new_amount").alias("total"), F.sum("old_amount").alias("old_total"), F.count_if(F.col("size") > 50).alias("large_parts"),
        F.sum("n_struck").alias("struck"), F.count_if(~F.col("anchor_upper.kind").isin(*A.RULES)).alias("unknown_rules"),
    )
    return out


@query(ITEMS + """
select * from (values ('survivor placed once', 0), ('every survivor placed', 0), ('only survivors placed', 0), ('amounts balance', 0), ('labels unique', 0)) t("rule", violations)""")
def bill_plan_invariants(spark, sf_dir):
    """A plan of all bills against the survivors that the tables themselves tell of."""
    cols = ["doc_id", "program", "fund", "chapter_year", "approp_id", "approp_amount"]
    key = F.to_json(F.struct(*cols)).alias("key")
    i = items(spark, sf_dir).withColumn("approp_amount", F.col("amount")).withColumn("rounded", X.round_up(F.col("amount")))
    own = i.where("(k % 7 = 0 or (k % 3 = 0 and fund = 'General Fund')) and k % 10 <> 3 and amount >= 1000").select(key, "rounded")
    rows = bill_plan(spark, sf_dir)
    labels = rows.select("doc_id", "label", "group_no").distinct().select("doc_id", "label")
    return A.invariants(own, labels, PL.placed(rows).select(key, "rounded"), "key", ["doc_id", "label"], "rounded")


#: Every fourth item is an appropriation of the year, the others are carried; programs of two segments are another agency's, whose pages come last.
SOURCES = """
, e as (select *, k % 4 = 0 fresh, case when program in ('BUILDING PROGRAM', 'MACHINERY PROGRAM') and k % 4 <> 0 then 'HEALTH DEPARTMENT' else 'EDUCATION DEPARTMENT' end agency from i),
s as (select *, cast(ceil(amount / 1000.0) * 1000 as bigint) rounded from e where (k % 7 = 0 or (k % 3 = 0 and fund = 'General Fund')) and k % 10 <> 3 and amount >= 1000)
"""


@query(ITEMS + SOURCES + """
select doc_id, count(*) filter (fresh) appended, count(*) filter (not fresh and rounded <> amount) replaced, cast(coalesce(sum(rounded) filter (fresh or rounded <> amount), 0) as bigint) new_total, count(*) filter (agency = 'HEALTH DEPARTMENT') second_agency,
cast(100 + cast(regexp_extract(doc_id, '([0-9]+)', 1) as int) as int) first_page, 0 fresh_chapter_headers, 0 missing_in_tracker from s group by doc_id""")
def bill_both_sources(spark, sf_dir):
    """One plan over appropriations and reappropriations of two agencies, with page numbers from the file's name: its edits, and its labels in the current version."""
    from .sources.stages import passing

    i = items(spark, sf_dir)
    fresh, second = F.col("k") % 4 == 0, F.col("program").isin("BUILDING PROGRAM", "MACHINERY PROGRAM")
    other = "HEALTH DEPARTMENT"
    # behind a year, what was new is carried like the rest, under the year in which it was new
    carried = i.where("k % 7 <> 0 and (k % 3 <> 0 or fund <> 'General Fund')").withColumn("chapter_year", F.when(fresh, 2025).otherwise(F.col("chapter_year")))
    number = lambda df: df.withColumn("rec_idx", F.col("approp_id").cast("bigint") * 10_000_000_000_000 + F.pmod(F.xxhash64(*RECORD_COLS), F.lit(10_000_000_000_000)))
    agency = F.when(second & ~fresh, other).otherwise(RD.AGENCY).alias("agency")
    year = F.when(fresh, 2025).otherwise(F.col("chapter_year")).alias("chapter_year")
    balances = i.where("k % 10 <> 3").select(agency, "approp_id", year, F.col("amount").alias("approp_amount"), F.col("amount").alias("reapprop_amount"), F.col("amount").cast("double").alias("balance"), F.col("k").alias("row_idx"))
    file_name = F.concat(F.lit("bill pg"), F.regexp_extract("doc_id", "([0-9]+)", 1).cast("int") + 100, F.lit("-450.html"))
    with passing(spark) as keep:
        before = bill_lines(RD.bound(RD.approp_bill(i.where(fresh)), RD.reapprop_bill(i.where(~fresh & ~second)), RD.reapprop_bill(i.where(~fresh & second), agency=other)))
        later = bill_lines(RD.bound(RD.reapprop_bill(carried.where(fresh | ~second)), RD.reapprop_bill(carried.where(~fresh & second), agency=other)))
        with passing(spark) as rows:
            with passing(spark) as records:
                prior = records(number(EX.new_records(before).unionByName(EX.carried_records(before))))
            with passing(spark) as records:
                current = records(number(EX.carried_records(later)))
            p = rows(PL.plan(prior, current, balances, page_offset=D.first_page_of(file_name)))
        with passing(spark):
            script = PL.edits(p, before)
            changed = F.col("op").isin("append", "replace")
            new = E.carried_amount(F.reverse(F.split(F.col("new"), " \\.\\.\\. "))[0])
            out = keep(script.groupBy("doc_id").agg(F.count_if(F.col("op") == "append").alias("appended"), F.count_if(F.col("op") == "replace").alias("replaced"), F.coalesce(F.sum(F.when(changed, F.coalesce(new, E.carried_amount(F.col("new"))))), F.lit(0)).alias("new_total")))
        told = keep(p.groupBy("doc_id").agg(
            F.count_if(F.col("agency") == other).alias("second_agency"), F.min(F.col("label_page") - F.col("anchor.page")).cast("int").alias("first_page"),
            F.count_if((F.col("source") == "appropriation") & F.col("needs_chapter_header")).alias("fresh_chapter_headers"),
        ))
        targets = p.select("doc_id", "label", F.col("anchor.page").alias("page_idx"), F.col("anchor.line").alias("line")).distinct()
        placed = E.located(later, targets, ["doc_id"]).where("p_idx >= 0")
        text = E.with_inserts(later, placed, ["doc_id"], F.col("raw_text")).where(F.col("label") != "")
        missing = keep(targets.join(text.select("doc_id", "label"), ["doc_id", "label"], "left_anti").groupBy("doc_id").agg(F.count("*").alias("missing_in_tracker")))
    return out.join(told, "doc_id").join(missing, "doc_id", "left").fillna(0, ["missing_in_tracker"])


@query()
def bill_plan_labels(spark, sf_dir):
    """Labels of the plan with their anchors; tests hold them against a walk over the records."""
    p = PL.nested(bill_plan(spark, sf_dir), ["doc_id"])
    return p.select("doc_id", "label", "anchor_upper.*", F.size("survivors").alias("survivors"), "first_page", "last_page")


@query("select o_orderkey k, o_custkey c, o_orderpriority p, o_orderstatus s, cast(round(o_totalprice*100) as bigint) a, case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 then '' else 'line ' || chr(10) || '\"' || o_orderkey || '\"' end t from orders")
def stage_roundtrip(spark, sf_dir):
    """A stage written as CSV, read, written as JSON and read again: nulls, empty texts, quotes and newlines stay."""
    from .sources.stages import shared_path

    text = F.when(F.col("o_orderkey") % 5 == 0, None).when(F.col("o_orderkey") % 5 == 1, "").otherwise(F.concat(F.lit('line \n"'), F.col("o_orderkey").cast("string"), F.lit('"')))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("s"), cents("o_totalprice").alias("a"), text.alias("t"))
    at = shared_path(spark)
    RS.write_csv(o, f"{at}/csv")
    back = RS.read_csv(spark, f"{at}/csv", o.schema)
    RS.write_json(back, f"{at}/json")
    return RS.read_json(spark, f"{at}/json", o.schema)
