"""One query for each operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import (
    ann,
    centroids,
    exact,
    html,
    licenses,
    lines,
    merkle,
    mixing,
    packing,
    quality,
    simhash,
    toxicity,
    warc,
)
from millwright.llm.common import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_html(spark, sf_dir):
    return html.main_texts(table(spark, sf_dir, "pages"))


@query
def op2_toxicity(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_warc(spark, sf_dir):
    index = stored(warc.write(table(spark, sf_dir, "pages")), "warc-index")
    return warc.read(index, payload=False)


ORACLE["op3_warc"] = """
with p as (
    select page_id, url, coalesce(html, '') as payload, sha1(coalesce(html, '')) as payload_digest,
           strlen(coalesce(html, '')) as payload_bytes
    from pages
), g as (
    select payload_digest, max(page_id) as holder from p where payload_bytes >= 1000 group by 1
)
select p.page_id, p.url, p.payload_bytes, p.payload_digest,
       case when holder is not null and holder <> p.page_id then 'revisit' else 'response' end as record_type,
       case when holder <> p.page_id then holder end as refers_to
from p left join g on p.payload_digest = g.payload_digest and p.payload_bytes >= 1000
"""


@query
def op4_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, max_bits=2)


@query
def op5_packing(spark, sf_dir):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, capacity=2048, end=0)


@query
def op6_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLE["op6_mixing"] = """
with d as (
    select doc_id, source, md5('mix:' || doc_id) as ord,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size
    from documents
), s as (
    select source, sum(size)::bigint as source_size,
           (row_number() over (order by source nulls last) - 1) % 3 as turn
    from d group by source
), w as (
    select *, case turn when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as weight,
           case turn when 0 then 4.0::double when 1 then 1.0::double else 1.5::double end as first,
           case turn when 0 then 2.0::double when 1 then 1.0::double else 2.5::double end as last
    from s
), r as (
    select *, 1.5::double * sum(source_size) over ()
              - coalesce(sum(2 * source_size) over (order by source_size / weight, source nulls last
                    rows between unbounded preceding and 1 preceding), 0)::double as free,
           sum(weight) over (order by source_size / weight, source nulls last
                    rows between current row and unbounded following) as free_weight
    from w
), l as (
    -- sources in the order in which caps are met; the first whose share is below its cap ends it
    select free, free_weight from r where free * weight / free_weight <= 2 * source_size
    order by source_size / weight, source nulls last limit 1
), t as (
    select w.*, case when l.free * weight / l.free_weight > 2 * source_size then 2.0::double * source_size
                     else l.free * weight / l.free_weight end as target
    from w, l
), c as (
    select doc_id, size, source_size, target, first, last,
           coalesce(sum(size) over (partition by d.source order by ord
                    rows between unbounded preceding and 1 preceding), 0)::bigint as c,
           case when source_size > 0 then floor(target / source_size)::bigint else 0 end as passes
    from d join t on d.source is not distinct from t.source
), k as (
    select *, case when size > 0 then passes + (c + size / 2.0::double <= target - passes * source_size)::int else 0 end
              as copies
    from c
)
select doc_id, size, source_size, target, (size * copies)::bigint as taken, copies::int as copies,
       case when copies > 0 then 2 * (least(c / target, 1.0::double) * (first + last) / 2)
            / (first + sqrt(first * first + 2 * (last - first) * (least(c / target, 1.0::double) * (first + last) / 2)))
       end as position
from k
"""


@query
def op7_lines(spark, sf_dir):
    return lines.deduplicated(table(spark, sf_dir, "documents"), similarity=0.8)


@query
def op8_quality(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


@query
def op9_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op10_nearest(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), asked=F.col("vec_id") % 50 == 0, k=5)


@query
def op11_merkle(spark, sf_dir):
    return merkle.audit(table(spark, sf_dir, "documents"), presented=merkle.without_breaks())


ORACLE["op11_merkle"] = """
with recursive d as (
    select doc_id, '=' || source as named, text, lang, source, n_chars from documents
), f as (
    select *, case when text is not null and list_reduce(
               list_transform(range(length(doc_id::varchar)), lambda i: ascii(substr(doc_id::varchar, (i + 1)::int, 1))::bigint),
               lambda c, b: list_reduce(range(8), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end,
                                     xor(c, b)), 4294967295::bigint) & 1 = 1
            then replace(text, chr(10), '') else text end as shown
    from d
), leaf as (
    select doc_id, coalesce(named, '') as key,
           sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
           sha256(head || coalesce(strlen(shown) || ':' || shown, '-')) as shown
    from (select *, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                    || coalesce(strlen(lang) || ':' || lang, '-')
                    || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head from f)
), placed as (
    select *, row_number() over (partition by key order by doc_id nulls first, leaf) - 1 as pos from leaf
), tree as (
    select key, 0 as level, pos, leaf as node, count(*) over (partition by key) as n from placed
    union all
    select key, level + 1, pos // 3, sha256(string_agg(node, '' order by pos)), (n + 2) // 3
    from tree where n > 1 group by key, level, pos // 3, n
), tops as (
    select key, node, row_number() over (order by key) - 1 as pos, count(*) over () as n from tree where n = 1
), above as (
    select 0 as level, pos, node, n from tops
    union all
    select level + 1, pos // 3, sha256(string_agg(node, '' order by pos)), (n + 2) // 3
    from above where n > 1 group by level, pos // 3, n
), height as (
    select key, max(level) as height from tree group by key
), beside as (
    select key, level, pos, n from tree where n > 1
), steps as (
    -- for every node below a root: what stands left and right of it in its run
    select b.key, b.level, b.pos,
           coalesce(string_agg(t.node, '' order by t.pos) filter (where t.pos < b.pos), '') as l,
           coalesce(string_agg(t.node, '' order by t.pos) filter (where t.pos > b.pos), '') as r
    from beside b join tree t on t.key = b.key and t.level = b.level and t.pos // 3 = b.pos // 3
    group by b.key, b.level, b.pos
), outer_steps as (
    select b.level, b.pos,
           coalesce(string_agg(t.node, '' order by t.pos) filter (where t.pos < b.pos), '') as l,
           coalesce(string_agg(t.node, '' order by t.pos) filter (where t.pos > b.pos), '') as r
    from above b join above t on t.level = b.level and t.pos // 3 = b.pos // 3
    where b.n > 1 group by b.level, b.pos
), way as (
    select p.key, p.pos, s.level as step, s.l, s.r
    from placed p join steps s on s.key = p.key and s.pos = p.pos // (3 ** s.level)::bigint
    union all
    select p.key, p.pos, h.height + s.level, s.l, s.r
    from placed p join height h on h.key = p.key join tops t on t.key = p.key
    join outer_steps s on s.pos = t.pos // (3 ** s.level)::bigint
), proof as (
    select key, pos, sha256(string_agg(l || r, '' order by step)) as proof_sha256, count(*) as n from way group by key, pos
), folded as (
    select key, pos, shown as node, 0 as step from placed
    union all
    select f.key, f.pos, sha256(w.l || f.node || w.r), f.step + 1
    from folded f join way w on w.key = f.key and w.pos = f.pos and w.step = f.step
), ends as (
    select key, pos, arg_max(node, step) as folded_root from folded group by key, pos
), root as (
    select node as root from above where n = 1
)
select p.doc_id, p.leaf, t.node as subroot, root.root, coalesce(proof.proof_sha256, sha256('')) as proof_sha256,
       ends.folded_root, ends.folded_root = root.root as verified
from placed p join tops t on t.key = p.key cross join root
join ends on ends.key = p.key and ends.pos = p.pos
left join proof on proof.key = p.key and proof.pos = p.pos
"""


@query
def op12_exact(spark, sf_dir):
    return exact.copies(table(spark, sf_dir, "documents"))


ORACLE["op12_exact"] = """
with d as (
    select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as text from documents
), g as (
    select text, min(doc_id) as keep_id, count(*) as group_size from d group by text
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(d.text) as text_sha256 from d join g on d.text = g.text
"""


@query
def op13_centroids(spark, sf_dir):
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


def _round(n: int) -> str:
    """SQL: the vectors' nearest centroids of c{n}, as a{n}, and the means that follow, as c{n+1}."""
    return f"""
d{n} as (
    select v.r, c.c, sum((v.x - c.x) * (v.x - c.x))::bigint as d
    from parts v join c{n} c on v.j = c.j group by v.r, c.c
), a{n} as (
    select r, first(c order by d, c) as c, min(d) as d from d{n} group by r
), m{n} as (
    select a.c, p.j, sum(p.x)::bigint as s, count(*) as n from a{n} a join parts p on p.r = a.r group by a.c, p.j
), c{n + 1} as (
    select o.c, o.j, case when m.n is null then o.x else (m.s - ((m.s % m.n) + m.n) % m.n) // m.n end as x
    from c{n} o left join m{n} m on m.c = o.c and m.j = o.j
)"""


ORACLE["op13_centroids"] = f"""
with kept as (
    select vec_id, row_number() over (order by sha256('1:' || vec_id)) - 1 as r,
           list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as q
    from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
), parts as (
    select r, unnest(range(64)) as j, unnest(q) as x from kept
), c0 as (
    select r as c, j, x from parts where r < 16
), {",".join(_round(n) for n in range(4))}, sums as (
    select c, sum(d)::bigint as s from a3 group by c
), shas as (
    select c, sha256(string_agg(x::varchar, ',' order by j)) as h from c3 group by c
)
select k.vec_id, a.c::int as cluster, a.d as distance, sums.s as cluster_inertia,
       (select sum(s) from sums)::bigint as inertia, shas.h as centroid_sha256
from a3 a join kept k on k.r = a.r join sums on sums.c = a.c join shas on shas.c = a.c
"""
