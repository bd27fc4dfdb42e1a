"""DuckDB SQL of the queries that SQL can express."""

_BARE = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"

ORACLE_SQL = {
    "op4_exact_dedup": f"""
        with d as (select doc_id, coalesce(text, '') as text, {_BARE} as content from documents),
        g as (select doc_id, content,
                first_value(doc_id) over (partition by content order by length(text) desc, doc_id) as keep_id,
                count(*) over (partition by content) as group_size from d)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(content) as text_sha256 from g
    """,
    "op3_url_rules": r"""
        with r(verdict, rule) as (values ('allow', 'com/'), ('block', 'example.com/en/'),
                ('allow', 'www.example.com/en/'), ('block', 'net/es/'), ('block', 'net/fr/')),
        p as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
              from pages),
        q as (select page_id, regexp_extract(rest, '^[^/?#]*') as raw,
                substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) as tail from p),
        u as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(tail, '^[^?#]*') as path from q),
        m as (select u.*, r.rule, r.verdict, row_number() over (partition by page_id order by length(r.rule) desc nulls last) as n
              from u left join r on ends_with('.' || host, '.' || split_part(r.rule, '/', 1))
                and starts_with(path, substr(r.rule, strpos(r.rule, '/'))))
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from m where n = 1
    """,
    "op5_line_quality": r"""
        with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents),
        ids as (select r, coalesce(cast(doc_id as varchar), 'row ' || r) as id from d),
        w as (select r, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from d),
        windows as (select r, unnest(range(1, len(ws) - 1)) as i, ws from w where len(ws) > 2),
        grams as (select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g from windows),
        found as (select r, i, count(*) over (partition by r, g) as n from grams),
        repeats as (select r, count(distinct i + o) as n from found, (values (0), (1), (2)) as t(o) where n > 1 group by r),
        l as (select r, source, text, unnest(string_split(text, chr(10))) as line from d),
        worded as (select *, list_filter(string_split_regex(regexp_replace(lower(line), '[1-9]', '0', 'g'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from l where regexp_matches(line, '[^\x20\x09-\x0D]')),
        dups as (select r, count(*) - count(distinct line) as n from worded group by r),
        keyed as (select r, source, text, array_to_string(ws, ' ') as key, len(ws) as n from worded),
        hosts as (select source, greatest(20.0, 0.02 * count(distinct id)) as most from d join ids using (r) group by source),
        boiler as (select k.source, k.key from keyed k join ids on k.r = ids.r join hosts h on k.source is not distinct from h.source
                group by k.source, k.key, h.most having count(distinct ids.id) > h.most),
        removed as (select k.r, sum(k.n) as n from keyed k join boiler b
                on k.source is not distinct from b.source and k.key = b.key group by k.r),
        m as (select d.r, d.doc_id, len(w.ws) as n_words,
                length(array_to_string(w.ws, '')) as word_chars,
                length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
                coalesce(dups.n, 0) as n_dup_lines, coalesce(repeats.n, 0) as n_repeat_words,
                cast(coalesce(removed.n, 0) as bigint) as n_boilerplate_words
              from d join w using (r) left join repeats using (r) left join dups using (r) left join removed using (r))
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, n_boilerplate_words,
            not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
                and n_words - n_boilerplate_words >= 0.5 * n_words as kept
        from m
    """,
    "op13_warc_segments": """
        with p as (select page_id, coalesce(html, '') as h from pages),
        f as (select *, min(page_id) over (partition by h) as low from p)
        select page_id, strlen(h) as payload_bytes, sha256(h) as payload_digest,
            case when strlen(h) >= 100 and page_id is distinct from low and low is not null then 'revisit' else 'response' end as record_type,
            case when strlen(h) >= 100 and page_id is distinct from low then low end as refers_to
        from f
    """,
    "op12_four_russians": """
        with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
              from embeddings where vec_id is not null and label is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select a.vec_id as anchor_id, c.vec_id as id, a.label = c.label as same,
                cast(list_inner_product(a.q, c.q) as bigint) as score
              from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 50 = 0),
        p as (select anchor_id, id as positive_id, score as positive_score from s where same
              qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
        n as (select p.*, s.id as negative_id, s.score as negative_score,
                cast(row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.id) as integer) as rank
              from p join s on p.anchor_id = s.anchor_id and not s.same
                and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score)
        select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 3
    """,
}
