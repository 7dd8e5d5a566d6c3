"""DuckDB counterparts of the operators that SQL can express."""

from __future__ import annotations


def subvector_sql(k: int, rounds: int) -> str:
    """K-means over the whole vectors, a pair of tables a round."""
    parts = [
        f"""with kept as materialized (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
centroids_0 as materialized (
  select row_number() over (order by sha256('2:' || vec_id)) - 1 as c, v as m
  from kept qualify c < {k})"""
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""near_{i} as materialized (
  select vec_id, v, c, d from (
    select vec_id, v, c, list_sum(list_transform(list_zip(v, m),
      lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
    from kept, centroids_{i})
  qualify row_number() over (partition by vec_id order by d, c) = 1)"""
        )
        if i < rounds:
            parts.append(
                f"""means_{i} as (
  select c, list((s - ((s % n) + n) % n) // n order by place) as m
  from (
    select c, place, sum(x)::bigint as s, count(*) as n
    from (select c, unnest(v) as x, generate_subscripts(v, 1) as place from near_{i})
    group by c, place)
  group by c),
centroids_{i + 1} as materialized (
  select c, coalesce(new.m, old.m) as m
  from centroids_{i} as old left join means_{i} as new using (c))"""
            )
    return (
        ",\n".join(parts)
        + f"""
select vec_id, c::int as cluster, d as distance,
  (sum(d) over (partition by c))::bigint as cluster_inertia,
  (sum(d) over ())::bigint as inertia,
  sha256(array_to_string(m, ',')) as centroid_sha256
from near_{rounds} join centroids_{rounds} using (c)"""
    )


# crc32 goes by its table of 256 remainders, made by the rule of its polynomial.
IMPORTANCE = r"""with remainders as (
  select list(list_reduce([i]::bigint[] || range(8),
    lambda c, step: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)
    order by i) as t
  from range(256) as r(i)),
doc_words as materialized (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents),
target_words as materialized (
  select unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w
  from benchmark),
counts as materialized (
  select doc_id, w, count(*) as n
  from (select doc_id, unnest(words) as w from doc_words) group by doc_id, w),
known as materialized (
  select w, xor(list_reduce([4294967295]::bigint[] || list_transform(range(0, len(h), 2),
      lambda i: ('0x' || substr(h, i + 1, 2))::bigint),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 as bucket
  from (select w, hex(encode(w)) as h
        from (select w from counts union select w from target_words)), remainders),
in_corpus as (select bucket, sum(n) as s from counts join known using (w) group by bucket),
in_target as (select bucket, count(*) as t from target_words join known using (w) group by bucket),
totals as (
  select (select coalesce(sum(s), 0) from in_corpus) as big_s,
    (select coalesce(sum(t), 0) from in_target) as big_t),
gains as materialized (
  select bucket, floor(1000 * ln(
    ((coalesce(t, 0) + 1) * (big_s + 10000)::double) / ((s + 1) * (big_t + 10000)::double)
    ))::bigint as gain
  from in_corpus left join in_target using (bucket), totals),
weights as (
  select doc_id, sum(n)::bigint as f, sum(n * gain)::bigint as total
  from counts join known using (w) join gains using (bucket) group by doc_id),
scored as (
  select doc_id, len(words) as n_words, coalesce(f, 0) as n_features,
    coalesce((total - ((total % f) + f) % f) // f, 0)::bigint as weight,
    ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint as h
  from doc_words left join weights using (doc_id)),
noisy as (
  select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score
  from scored),
placed as (
  select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n
  from noisy where n_words >= 20)
select doc_id, n_features::bigint as n_features, weight, score,
  case when r <= 10 * n // 100 then r end as rank
from noisy left join placed using (doc_id)"""
