"""The operators as queries over whole tables, and what of them SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .compression import op11_vector_codes
from .fingerprints import op2_fingerprints
from .language import op8_language
from .mixing import op1_mixing
from .neardup import op7_neardup
from .negatives import op12_hard_negatives
from .packing import op6_packing
from .pii import op3_pii
from .quality import op10_quality
from .search import op4_search
from .sharding import op9_sharding
from .simhash import op13_simhash
from .substrings import op5_substrings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mixing, op2_fingerprints, op3_pii, op4_search, op5_substrings, op6_packing, op7_neardup, op8_language, op9_sharding, op10_quality, op11_vector_codes, op12_hard_negatives, op13_simhash)
}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_FINITE = "embedding is not null and list_count(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)"
_INTEGERS = "list_transform(embedding, lambda x: floor(256 * x::double)::bigint)"


def _rounds(n: int) -> str:
    """Assignments a0 to an and codebooks c0 to cn in turn."""
    return ", ".join(
        f"""
a{r} as (select vec_id, p, min(d * 64 + e) as de from (
    select parts.vec_id, parts.p, e, list_sum(list_transform(list_zip(parts.s, c{r}.s), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
    from parts join c{r} on c{r}.p = parts.p) group by vec_id, p),
m{r} as (select p, e, list(((total - ((total % n) + n) % n) // n)::bigint order by j) as s from (
    select a{r}.p, de % 64 as e, j, sum(parts.s[j])::bigint as total, count(*)::bigint as n
    from a{r} join parts on parts.vec_id = a{r}.vec_id and parts.p = a{r}.p, unnest(range(1, len(parts.s) + 1)) as t(j) group by 1, 2, 3) group by p, e),
c{r + 1} as (select c{r}.p, c{r}.e, coalesce(m{r}.s, c{r}.s) as s from c{r} left join m{r} on m{r}.p = c{r}.p and m{r}.e = c{r}.e)"""
        for r in range(n + 1)
    )


ORACLE_SQL: dict[str, str] = {
    "op11_vector_codes": f"""
with kept as (select vec_id, label, {_INTEGERS} as v from embeddings where {_FINITE}),
parts as (select vec_id, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] as s from kept, unnest(range(0, 16)) as t(p)),
c0 as (select p, (row_number() over (partition by p order by vec_id) - 1)::bigint as e, s from parts where vec_id in (select vec_id from kept order by vec_id limit 64)),
{_rounds(2)},
coded as (select vec_id, string_agg(printf('%02x', de % 64), '' order by p) as code, sum(de // 64)::bigint as error from a2 group by vec_id),
book as (select sha256(string_agg(array_to_string(s, ','), ',' order by p, e)) as codebooks_sha256 from c2)
select kept.vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from kept join coded on coded.vec_id = kept.vec_id, book
""",
    "op12_hard_negatives": f"""
with kept as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, {_INTEGERS}::double[] as v from embeddings where label is not null and {_FINITE}),
scores as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score from kept a join kept b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
positives as (select anchor_id, id as positive_id, score as positive_score from scores where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, positive_id, (row_number() over (partition by p.anchor_id, positive_id order by score desc, id))::int as rank, id as negative_id, positive_score, score as negative_score
from positives p join scores s on s.anchor_id = p.anchor_id and not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify row_number() over (partition by p.anchor_id, positive_id order by score desc, id) <= 3
""",
    "op5_substrings": rf"""
with d as (select doc_id, {_WORDS} as w from documents),
windows as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as s from d, unnest(range(1, greatest(len(w) - 18, 1))) as t(i)),
placed as (select doc_id, i, row_number() over (partition by s order by doc_id, i) as n from windows),
gone as (select distinct doc_id, i + k as p from placed, range(0, 20) as r(k) where n > 1),
places as (select doc_id, p, w[p] as word from d, unnest(range(1, len(w) + 1)) as t(p)),
kept as (
  select places.doc_id, count(*) as n_words, count(gone.p) as n_removed,
         coalesce(string_agg(word, ' ' order by places.p) filter (where gone.p is null), '') as kept
  from places left join gone on places.doc_id = gone.doc_id and places.p = gone.p group by places.doc_id)
select d.doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join kept on d.doc_id = kept.doc_id
""",
    "op7_neardup": rf"""
with recursive lowered as (select doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
d as (select doc_id, {_WORDS} as w from lowered),
shingles as (select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s from d, unnest(range(1, greatest(len(w) - 2, 2))) as t(i) where len(w) > 0),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
reach(id, r) as (select doc_id, doc_id from documents union select reach.id, links.b from reach join links on links.a = reach.r),
least_ as (select id, min(r) as component_id from reach group by id)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, component_id = d.doc_id as kept
from d join least_ on least_.id = d.doc_id left join sizes on sizes.doc_id = d.doc_id
""",
}
