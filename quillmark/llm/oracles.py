"""SQL that gives the rows of those queries which SQL can express."""

#: The article of the generated pages, which hold p, b, br and h1 only; other pages need the operator.
OP2 = r"""
with a as (select page_id, url, regexp_extract(html, '(?s)<article>(.*?)(?:</article>|<footer>|$)', 1) t from pages),
b as (select page_id, url, string_split_regex(t, '</?(?:p|h1)\b[^>]*>') parts from a),
c as (select page_id, url, list_transform(parts, lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(x, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g'),
  '&quot;', '"'), '&quot', '"'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&amp;', '&'), '&amp', '&'), '\s+', ' ', 'g'))) parts from b),
d as (select page_id, url, coalesce(array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)), '') as text from c)
select page_id, url, text, length(text) n_chars from d
"""

OP5 = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') a from documents),
n as (select doc_id, a, len(a) n from w),
s as (select distinct doc_id, array_to_string(a[i:i+4], ' ') g from (select doc_id, a, unnest(generate_series(1, n - 4)) i from n where n >= 5)
      union all select doc_id, array_to_string(a, ' ') from n where n between 1 and 4),
z as (select doc_id, count(*) c from s group by 1),
p as (select x.doc_id a, y.doc_id b, count(*) i from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2),
l as (select a, b from p join z u on u.doc_id = a join z v on v.doc_id = b where 100 * i >= 75 * (u.c + v.c - i)),
e as (select a, b from l union select b, a from l),
r as (select doc_id v, doc_id t from documents union select e.b, r.t from r join e on r.v = e.a where r.t < e.b),
m as (select v, min(t) t from r group by 1)
select d.doc_id, cast(coalesce(z.c, 0) as bigint) n_shingles, m.t component_id, m.t = d.doc_id kept from documents d left join z using (doc_id) join m on m.v = d.doc_id
"""


def clusters(k: int = 40, rounds: int = 5, seed: int = 2, size: int = 64) -> str:
    """Lloyd's rounds as one select after another over whole numbers."""
    near = """a{r} as (select vec_id, x, c, d from (select v.vec_id, v.x, m.c, list_sum(list_transform(range(1, {size} + 1), lambda i: (v.x[i] - m.x[i]) * (v.x[i] - m.x[i]))) d from v, c{r} m)
      qualify row_number() over (partition by vec_id order by d, c) = 1)"""
    move = """c{n} as (select m.c, coalesce(e.x, m.x) x from c{r} m left join (select c, list(s order by i) x from
      (select c, i, (sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*) s from a{r}, range(1, {size} + 1) t(i) group by c, i) group by c) e using (c))"""
    steps = [f"""v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) x from embeddings
      where len(embedding) = {size} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)"""]
    steps.append(f"c0 as (select row_number() over (order by sha256('{seed}:' || vec_id)) - 1 c, x from v qualify c < {k})")
    for r in range(rounds):
        steps += [near.format(r=r, size=size), move.format(r=r, n=r + 1, size=size)]
    steps.append(near.format(r=rounds, size=size))
    final = f"""select vec_id, cast(a.c as int) as cluster, cast(d as bigint) distance, cast(sum(d) over (partition by a.c) as bigint) cluster_inertia,
      cast(sum(d) over () as bigint) inertia, sha256(array_to_string(m.x, ',')) centroid_sha256 from a{rounds} a join c{rounds} m on m.c = a.c"""
    return "with " + ",\n".join(steps) + "\n" + final


#: Every window as one string.
OP12 = r"""
with w as (select row_number() over () r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') a from documents),
s as (select r, i, array_to_string(a[i:i+34], ' ') g from (select r, a, unnest(generate_series(1, len(a) - 34)) i from w where len(a) >= 35)),
d as (select r, i from s where g in (select g from s group by g having count(*) > 1)),
c as (select distinct r, i + k i from d, range(35) t(k)),
p as (select r, i, a[i] word from (select r, a, unnest(generate_series(1, len(a))) i from w)),
k as (select r, string_agg(word, ' ' order by i) t from p anti join c using (r, i) group by r),
n as (select r, count(*) n from c group by r)
select doc_id, cast(len(a) as bigint) n_words, cast(coalesce(n.n, 0) as bigint) n_removed, sha256(coalesce(k.t, '')) kept_sha256 from w left join k using (r) left join n using (r)
"""
