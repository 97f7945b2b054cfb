"""DuckDB text of the queries that SQL can state on whole tables."""

from __future__ import annotations

_SIGN = r"'[^\x20\x09-\x0D]+'"

SQL: dict[str, str] = {}

# Every window of 200 bytes by its hash; a byte goes if one of the 200 windows that cover it occurs twice.
SQL["op2_suffix_dedup"] = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
bytes as (select doc_id, h, unnest(range(0, length(h) // 2)) as p from d),
windows as (select doc_id, p, substr(h, 2 * p + 1, 2) as b, case when 2 * p + 400 <= length(h) then md5(substr(h, 2 * p + 1, 400)) end as k from bytes),
counted as (select *, k is not null and count(*) over (partition by k) > 1 as twice from windows),
covered as (select *, coalesce(max(if(twice, p, null)) over (partition by doc_id order by p rows between unbounded preceding and current row) >= p - 199, false) as gone from counted),
edges as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by p), false) as opens from covered),
sums as (select doc_id, count(*) filter (gone) as n_removed, count(*) filter (opens) as n_spans, string_agg(b, '' order by p) filter (not gone) as kept from edges group by doc_id)
select doc_id, length(h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, ''))) as kept_sha256
from d left join sums using (doc_id)"""

# Every window of 20 words by its hash, in order of document and place; all but the first of each kind remove what they cover.
SQL["op3_relative_lz"] = f"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), {_SIGN}) as w from documents),
words as (select doc_id, w, unnest(range(1, len(w) + 1)) as p from d),
windows as (select doc_id, p, w[p] as word, case when p + 19 <= len(w) then md5(array_to_string(w[p:p + 19], ' ')) end as k from words),
ranked as (select *, k is not null and row_number() over (partition by k order by doc_id, p) > 1 as later from windows),
covered as (select *, coalesce(max(if(later, p, null)) over (partition by doc_id order by p rows between unbounded preceding and current row) >= p - 19, false) as gone from ranked),
sums as (select doc_id, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by p) filter (not gone) as kept from covered group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join sums using (doc_id)"""

# Links by counting shared shingles of every pair, then all that can be reached.
SQL["op8_minhash_components"] = f"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_SIGN}) as w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then []::varchar[] when len(w) < 3 then [array_to_string(w, ' ')] else [array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)] end) as k from d),
n as (select doc_id, count(*) as n from s group by all),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.k = b.k and a.doc_id <> b.doc_id group by all),
links as (select x, y from pairs join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 85 * (nx.n + ny.n - c)),
reach as (select x, y from links union select r.x, l.y from reach r join links l on l.x = r.y),
low as (select x, min(y) as y from reach group by x)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) as component_id, d.doc_id = least(d.doc_id, coalesce(y, d.doc_id)) as kept
from d left join n using (doc_id) left join low on x = d.doc_id"""


def _rounds(dimensions: int = 64, scale: int = 256, k: int = 40, rounds: int = 5, seed: str = "2") -> str:
    """Clustering as a chain of steps; entries are rows (id, place, value), and tables are kept as they are used twice."""
    steps = [f"d as materialized (select row_number() over () as id, vec_id, list_transform(embedding, lambda c: floor({scale} * c::double)::bigint) as x from embeddings "
             f"where embedding is not null and len(embedding) = {dimensions} and len(list_filter(embedding, lambda c: c is not null and isfinite(c))) = {dimensions})",
             f"e as materialized (select id, unnest(x) as v, unnest(range({dimensions})) as p from d)",
             f"f as (select x, row_number() over (order by sha256('{seed}:' || vec_id) nulls last, x) - 1 as c from d qualify c < {k})",
             f"c0 as materialized (select c, unnest(x) as v, unnest(range({dimensions})) as p from f)"]
    for r in range(rounds + 1):
        steps.append(f"far{r} as (select e.id, c.c, sum((e.v - c.v) * (e.v - c.v))::bigint as distance from e join c{r} c using (p) group by all)")
        steps.append(f"a{r} as materialized (select id, c, distance from far{r} qualify row_number() over (partition by id order by distance, c) = 1)")
        if r < rounds:
            steps.append(f"s{r} as (select a.c, e.p, sum(e.v)::bigint as s, count(*) as n from e join a{r} a using (id) group by all)")
            steps.append(f"c{r + 1} as materialized (select c.c, c.p, case when n is null then c.v else (s - ((s % n) + n) % n) // n end as v from c{r} c left join s{r} using (c, p))")
    steps.append(f"h as (select c, sha256(string_agg(v::varchar, ',' order by p)) as centroid_sha256 from c{rounds} group by c)")
    return (f"with {', '.join(steps)} select vec_id, c::int as cluster, distance, (sum(distance) over (partition by c))::bigint as cluster_inertia, "
            f"(sum(distance) over ())::bigint as inertia, centroid_sha256 from a{rounds} join h using (c) join d using (id)")


SQL["op12_centroid_simplex"] = _rounds()


def _licenses() -> str:
    """The rules as a table of values, tried at every word and pair of words; a finding falls to a better one around it."""
    from millrace.llm.license_rules import REACH
    from millrace.llm.license_signatures import WEIGHTS, rules

    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(r.keyword)}, {quoted(f'^({r.pattern})(?: |$)')}, {quoted(r.label)}, {r.tier}, {k}, {WEIGHTS[r.tier]}::double)" for k, r in enumerate(rules()))
    return rf"""
with rules(keyword, pattern, label, tier, number, weight) as materialized (values {values}),
d as materialized (select row_number() over () as id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
spots as (select id, w, unnest(range(len(w))) as i from d),
keys as (select id, i, w, unnest(list_distinct([w[i + 1], array_to_string(w[i + 1:i + 2], ' ')])) as keyword from spots),
tried as (select id, i, label, tier, number, weight, regexp_extract(array_to_string(w[i + 1:i + {REACH}], ' '), pattern, 1) as hit from keys join rules using (keyword)),
found as materialized (select *, i + len(string_split(hit, ' ')) as e from tried where hit <> ''),
kept as (select * from found b where tier = 0 or not exists (select 1 from found a where a.id = b.id and a.tier > 0 and a.i <= b.i and a.e >= b.e
  and (a.tier < b.tier or (a.tier = b.tier and (a.i < b.i or (a.i = b.i and (a.e > b.e or (a.e = b.e and a.number < b.number)))))))),
per as (select id, count(*) filter (tier = 0) as n_base, min(i) filter (tier = 0) as first_word, max(i) filter (tier = 0) as last_word,
  string_agg(distinct label, ',' order by label) filter (tier = 0) as base_labels, string_agg(distinct label, ',' order by label) as labels, max(weight) as score, count(*) filter (tier > 0) as n_found from kept group by id)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0) as score, coalesce(n_found, 0) as n_found
from d left join per using (id)"""


SQL["op13_license_rules"] = _licenses()
