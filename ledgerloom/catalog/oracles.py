"""SQL counterparts of the queries, for DuckDB on the same tables."""

from __future__ import annotations

VIEWS = {
    "fx_block": "select o_orderkey as height, cast(floor(o_totalprice) as bigint) % 40 as size from orders",
    "fx_shard": """
        select case l_returnflag when 'R' then 1 when 'A' then 2 else 3 end as priority,
               l_orderkey as height, cast(l_linenumber as bigint) as shard_id,
               cast(max(floor(l_extendedprice)) as bigint) % 25 as size
        from lineitem group by 1, 2, 3""",
    "fx_shard_obj": """
        select priority, height, 'shard_' || shard_id || '.json' as member, size from fx_shard""",
    "fx_block_obj": "select height, 'block.json' as member, size from fx_block",
    "fx_obj": """
        select 'data/' || printf('%012d', height) || '/' || member as key, height, member, size
        from (select height, member, size from fx_block_obj
              union all select height, member, size from fx_shard_obj)""",
    "fx_rng": "select distinct o_orderkey // 100 as b from orders",
    "fx_archive": """
        select concat('archives/', b*100, '-', b*100+99, case when b%2=0 then '.tar.zst' else '.TAR.GZ' end) as key,
               b*4096 as size from fx_rng where b%7<>3 and b%11<>5 and b%17<>8
        union all select concat('archives/', b*100+1, '-', b*100+99, '.tar.zst'), b*10 from fx_rng where b%11=5
        union all select concat('archives/', b*100, '-', b*100+99, '.tar.gz'), b*11 from fx_rng where b%13=6 and b%2=0
        union all select concat('archives/sub/', b*100, '-', b*100+99, '.tar.zst'), b*12 from fx_rng where b%17=8
        union all select concat('archives/000', b*100, '-', b*100+99, '.tar.zst'), b*13 from fx_rng where b%19=4
        union all select 'archives/README.txt', 1
        union all select 'archives/9-3.tar.gz', 2
        union all select 'archives/99999999999999999999-99999999999999999999.tar.gz', 3
        union all select '0-99.tar.gz', 4""",
    "fx_parsed_any": r"""
        select * from (
          select key, size, regexp_extract(key, '^(?:([^\n]+)/)?([0-9]+)-([0-9]+)\.tar\.(gz|zst)$', 1, 'i') as folder,
                 try_cast(regexp_extract(key, '^(?:([^\n]+)/)?([0-9]+)-([0-9]+)\.tar\.(gz|zst)$', 2, 'i') as bigint) as first,
                 try_cast(regexp_extract(key, '^(?:([^\n]+)/)?([0-9]+)-([0-9]+)\.tar\.(gz|zst)$', 3, 'i') as bigint) as last,
                 lower(regexp_extract(key, '^(?:([^\n]+)/)?([0-9]+)-([0-9]+)\.tar\.(gz|zst)$', 4, 'i')) as ext
          from fx_archive)
        where first >= 0 and last >= first""",
    "fx_parsed": "select * from fx_parsed_any where folder = 'archives'",
    "fx_src": "select concat('archives/', source, '/', doc_id) as key, n_chars as size, md5(text) as etag from documents",
    "fx_dst": """
        select concat('copied/', source, '/', doc_id) as key,
               case when doc_id%25=1 then n_chars+1 else n_chars end as size,
               case when doc_id%40=3 then concat(md5(text), '-2')
                    when doc_id%33=2 then md5(concat(text, 'x')) else md5(text) end as etag
        from documents where doc_id%10<>0""",
    "fx_request": """
        select event_id, case event_id%6 when 0 then 200 when 1 then 404 when 2 then 429
                                         when 3 then 500 when 4 then 503 else 301 end as status,
               concat('https://api.example.org/v0/block/', event_id,
                      case when event_id%2=0 then '?apiKey=K' else '' end) as url
        from events""",
    "fx_expected": """
        select first, least(first + 99, (select max(height) from fx_block)) as last
        from (select unnest(generate_series(0, (select max(height) from fx_block), 100)) as first)""",
    "fx_missing_range": "select first, last from fx_expected e where not exists (select 1 from fx_parsed a where a.first = e.first and a.last = e.last)",
    "fx_sources": "select case priority when 1 then 'first' else 'second' end as source, * from fx_shard_obj where priority <= 2",
    "fx_domain": "select unnest(generate_series(min(height), max(height))) as height from fx_block",
    "fx_no_block": "select height from fx_domain where height not in (select height from fx_block where size > 0)",
    "fx_wanted_shard": "select distinct height, shard_id from fx_shard",
    "fx_island": "select height, height - row_number() over (order by height) as island from fx_no_block",
    "fx_run": "select min(height) as run_start, max(height) as run_end, count(*) as n from fx_island group by island",
    "fx_large": "select o_orderkey as height, cast(floor(o_totalprice) as bigint) * 1000 as size from orders",
    "fx_winner": "select height, min(priority) as priority from fx_sources group by height",
    "fx_primary": """
        select height, member, size from fx_block_obj
        union all select height, member, size from fx_sources join fx_winner using (height, priority)""",
    "fx_fallback": """
        select height, member, size from fx_shard_obj where priority = 3
        union all select distinct height, 'block.json', 7 from fx_shard_obj where priority = 3""",
    "fx_miss_h": "select height from fx_domain where height not in (select height from fx_primary where member = 'block.json' and size > 0)",
    "fx_miss_s": """
        select height, shard_id from fx_wanted_shard w
        where height in (select height from fx_primary where member = 'block.json' and size > 0)
          and not exists (select 1 from fx_primary p where p.height = w.height and p.size > 0
                          and p.member = 'shard_' || w.shard_id || '.json')""",
    "fx_wanted": "select height from fx_miss_h union select height from fx_miss_s",
    "fx_fetched": "select * from fx_fallback where height in (select height from fx_wanted)",
    "fx_filled": """
        select p.height, p.member, p.size from fx_primary p
        left join (select distinct height as got_height, member as got_member from fx_fetched) f
          on p.height = f.got_height and p.member = f.got_member
        where f.got_height is null
        union all select height, member, size from fx_fetched""",
    "fx_after_h": "select height from fx_domain where height not in (select height from fx_filled where member = 'block.json' and size > 0)",
    "fx_after_s": """
        select height, shard_id from fx_wanted_shard w
        where height in (select height from fx_filled where member = 'block.json' and size > 0)
          and not exists (select 1 from fx_filled p where p.height = w.height and p.size > 0
                          and p.member = 'shard_' || w.shard_id || '.json')""",
    "fx_sealed": """
        select event_id // 1000 * 1000 as batch_start, event_id // 1000 * 1000 + 999 as batch_end, count(*) as dirs
        from events group by 1, 2
        having event_id // 1000 * 1000 + 1000 + 100 <= (select max(event_id) from events)""",
}
# Views that others use several times.
SHARED = {"fx_shard", "fx_primary", "fx_wanted", "fx_fetched", "fx_filled"}
_SEALED = "select batch_start, batch_end, dirs from fx_sealed"
_COMPACT = "select height // 1000 * 1000 as batch_start, count(*) as files, cast(sum(size) as bigint) as bytes from fx_sources group by 1"

ORACLES = {
    "scan_inventory": "select key, size from fx_obj",
    "height_domain": "select height from fx_domain",
    "expected_batches": """
        select batch_start, least(batch_start + 699, (select max(height) from fx_block)) as batch_end
        from (select unnest(generate_series(0, (select max(height) from fx_block), 700)) as batch_start)""",
    "read_heights": "select height, member, size from fx_obj where height in (select height from fx_no_block)",
    "expected_shards": "select height, cast(shard_id as varchar) as shard_id from fx_wanted_shard",
    "distinct_shards": "select height, shard_id from fx_wanted_shard",
    "split_envelope": """
        select height, 'block.json' as member,
               cast(length('{"height":' || height || ',"size":' || size || '}') as bigint) as size from fx_block
        union all
        select height, 'shard_' || shard_id || '.json', cast(length('{"shard_id":' || shard_id || '}') as bigint)
        from fx_wanted_shard where height in (select height from fx_block)""",
    "parse_batch_paths": """
        select concat('batch_', first, '_', last) as name, first, last from fx_expected
        union all select concat('batch_', last + 1, '_', first), last + 1, first from fx_expected where first > last""",
    "batch_dir": "select first as batch_start, last as batch_end, concat('batch_', first, '_', last) as name from fx_expected",
    "expand_archives": """
        select printf('%012d/block.json', doc_id) as member, cast(strlen(text) as bigint) as size, md5(text) as md5
        from documents""",
    "pack_archives": """
        select doc_id // 100 * 100 as batch_start, doc_id // 100 * 100 + 99 as batch_end, count(*) as members,
               cast(sum(strlen(text)) as bigint) as bytes from documents group by 1, 2""",
    "latest_height": "select max(event_id) as latest from events",
    "resume_point": "select coalesce(max(batch_end) + 1, 0) as next_height from fx_sealed",
    "compact_batches": _COMPACT,
    "write_heights": _COMPACT,
    "batch_inventory": """
        select concat('archives/', b, '-', b + 999, '.tar.zst') as key, b as batch_start, b + 999 as batch_end
        from (select distinct height // 1000 * 1000 as b from fx_sources)""",
    "replace_batches": """
        select height // 100 * 100 as batch_start, count(*) as files, cast(sum(size) as bigint) as bytes
        from fx_sources
        where size > 0 or height // 100 not in (select height // 100 from fx_no_block) group by 1""",
    "versioned_batches": """
        select height // 100 * 100 as batch_start, count(*) as files, cast(sum(size) as bigint) as bytes
        from fx_sources
        where size > 0 or height // 100 not in (select height // 100 from fx_no_block) group by 1""",
    "earlier_version": """
        select height // 100 * 100 as batch_start, count(*) as files, cast(sum(size) as bigint) as bytes
        from fx_sources group by 1""",
    "damaged_heights": """
        with found as (
            select height, count(*) as n,
                   case when height % 101 = 7 then 'extra' when height % 97 = 3 then 'changed' end as verdict
            from fx_sources group by height
        ), odd as (
            select height, case when verdict = 'extra' then 0 else n end as files, n as stored_files, verdict
            from found where verdict is not null
            union all select -height - 1, n, 0, 'missing' from found where height % 89 = 5
        )
        select cast(floor(height / 1000.0) * 1000 as bigint) as batch_start,
               cast(floor(height / 1000.0) * 1000 + 999 as bigint) as batch_end, height, files, stored_files, verdict
        from odd""",
    "archives_of_heights": """
        select n.height, a.key, a.first, a.last
        from fx_no_block n join (
            select key, first, last + case when first % 300 = 0 then 250 else 0 end as last from fx_parsed
        ) a on n.height between a.first and a.last""",
    "archive_parts": """
        select printf('%012d/block.json', doc_id) as member, cast(strlen(source) as bigint) as size, md5(source) as md5
        from documents
        union all select printf('%012d/shard_0.json', doc_id), cast(strlen(text) as bigint), md5(text) from documents""",
    "archive_headers": "select printf('%012d/block.json', doc_id) as member, source as header from documents",
    "verify_batches": f"select *, true as ok from ({_COMPACT})",
    "append_stats": """
        select concat(b, '-', b + 999) as batch, cast(bytes // 1048576 as bigint) as uncompressed_mb, dirs
        from (select height // 1000 * 1000 as b, sum(size) as bytes, count(distinct height) as dirs
              from fx_large group by 1)""",
    "audit_events": """
        select 'gap_found' as kind, height // 1000 * 1000 as batch_start, height, null::varchar as missing_range
        from fx_no_block
        union all select 'validate_ranges_missing', first, null, concat(first, '-', last) from fx_missing_range""",
    "save_progress": "select max(batch_end) as last_processed_number from fx_sealed having max(batch_end) is not null",
    "height_key": "select height, printf('data/%012d/', height) as key from fx_block",
    "rel_key": "select key, substr(key, 6) as rel from fx_obj",
    "archive_key": "select first as batch_start, concat('archives/', first, '-', last, '.tar.zst') as key from fx_expected",
    "parse_archives": "select key, first, last, ext from fx_parsed",
    "parse_archives_any_prefix": "select key, first, last, ext from fx_parsed_any",
    "codec_of": "select key, case when lower(key) like '%.tar.zst' then 'zstd' else 'gzip' end as codec from fx_archive",
    "height_of": """
        select key, height from fx_obj
        union all select concat('000000000007/', key), 7 from fx_obj""",
    "present_objects": "select height, member, size from fx_obj where size > 0",
    "scope_filter": """
        select key, first, last from fx_parsed
        where last >= (select min(height) + 100 from fx_block)
          and first <= (select greatest(max(height) - 100, 0) // 1000 * 1000 from fx_block)""",
    "dest_key": "select key, concat('copied/', substr(key, 10)) as dest_key from fx_src",
    "safe_boundary": "select event_id, greatest(event_id - 100, 0) // 1000 * 1000 as stop_at from events",
    "norm_shard_id": "select height, cast(shard_id as varchar) as shard_id from fx_wanted_shard",
    "shard_member": "select height, member from fx_shard_obj",
    "block_url": "select height, concat('https://api.example.org/v0/block/', height, '?apiKey=k+1%2A~') as url from fx_block",
    "redact_url": "select event_id, split_part(url, '?', 1) as url from fx_request",
    "etag_kind": "select key, case when regexp_matches(etag, '^[0-9a-fA-F]{32}$') then 'md5' else 'other' end as kind from fx_dst",
    "classify_status": """
        select event_id,
               case when status = 200 then 'ok' when status = 404 then 'not_found' when status = 301 then 'fallback'
                    when status in (500, 502, 503) then 'retryable' else 'fatal' end as store_class,
               case when status = 200 then 'ok' when status = 404 then 'not_found'
                    when status = 429 or status >= 500 then 'retryable' else 'fatal' end as http_class
        from fx_request""",
    "cap_bps": """
        select doc_id, case when doc_id % 2 = 0 and n_chars > 0 then n_chars
                            when doc_id > 0 then doc_id * 125000 else 0 end as bps from documents""",
    "unsafe_members": r"""
        select page_id, page_id % 7 = 0 or contains(regexp_replace(url, '^https?://[^/]+/', ''), '..') as unsafe from pages""",
    "valid_payload": "select event_id, event_id % 5 <> 0 and event_id % 7 <> 0 as ok from events",
    "size_metrics": """
        select height, size // 1048576 as uncompressed_mb, (size // 3) // 1048576 as compressed_mb,
               case when size > 0 then 100.0::double * (1.0::double - (size // 3)::double / size::double) else 0.0::double end as reduction_pct
        from fx_large""",
    "content_md5": "select doc_id, md5(text) as md5 from documents",
    "missing_heights": "select height from fx_no_block",
    "missing_shards": """
        select height, shard_id from fx_wanted_shard w
        where height in (select height from fx_block where size > 0)
          and not exists (select 1 from fx_shard s where s.height = w.height and s.shard_id = w.shard_id
                          and s.size > 0 and s.priority <= 2)""",
    "empty_runs": "select run_start, run_end, n from fx_run",
    "stop_height": "select min(run_start + 1) as height from fx_run where n >= 2",
    "heights_until": """
        select height from fx_domain
        where height <= coalesce((select min(run_start + 1) from fx_run where n >= 2), height)""",
    "first_source": """
        select height, cast(priority as bigint) as priority, count(*) as files, cast(sum(size) as bigint) as bytes
        from fx_shard_obj join (select height, min(priority) as priority from fx_shard group by height)
        using (height, priority) group by 1, 2""",
    "union_sources": "select source, cast(priority as bigint) as priority, height, member, size from fx_sources",
    "refetch_set": "select height from fx_wanted",
    "fill_gaps": "select height, member, size from fx_filled",
    "fallback_missing": "select height from fx_wanted where height not in (select height from fx_fallback)",
    "repair_gate": """
        select b as batch_start from (select unnest(generate_series(0, (select max(height) from fx_block), 10)) as b)
        where b not in (select height // 10 * 10 from fx_after_h)
          and b not in (select height // 10 * 10 from fx_after_s)""",
    "problem_report": """
        select height // 100 * 100 as batch_start, height, null::varchar as missing_shards from fx_miss_h
        union all
        select height // 100 * 100, height, string_agg(cast(shard_id as varchar), ',' order by cast(shard_id as varchar))
        from fx_miss_s group by 1, 2""",
    "problem_counts": """
        select batch_start, cast(sum(h) as bigint) as n_heights, cast(sum(s) as bigint) as n_shards
        from (select height // 100 * 100 as batch_start, 1 as h, 0 as s from fx_miss_h
              union all select height // 100 * 100, 0, 1 from fx_miss_s) group by 1""",
    "fill_totals": """
        select height // 1000 * 1000 as batch_start, count(*) as found,
               count(*) filter (height in (select height from fx_fallback)) as filled,
               count(*) filter (height not in (select height from fx_fallback)) as failed
        from fx_wanted group by 1""",
    "layout_check": """
        select batch_start, count(*) as folders, case when count(*) = 1 then min(parent) end as parent,
               case when count(*) = 1 then 'ok' else 'inconsistent' end as verdict
        from (select distinct height // 100 * 100 as batch_start,
                     case when height // 100 % 3 = 0 and height % 2 = 0 then 'alt/data' else 'data' end as parent
              from fx_block where size > 0) group by 1""",
    "missing_ranges": "select first, last from fx_missing_range",
    "pending_batches": """
        select first as batch_start, last as batch_end, concat('archives/', first, '-', last, '.tar.zst') as key
        from fx_expected where concat('archives/', first, '-', last, '.tar.zst') not in (select key from fx_archive)""",
    "first_archive": "select first, last, min(key) as key from fx_parsed group by 1, 2",
    "duplicate_archives": """
        select first, last, key, copies
        from fx_parsed join (select first, last, count(*) as copies from fx_parsed group by 1, 2 having count(*) > 1)
        using (first, last)""",
    "ordered_archives": "select first, last, key from fx_parsed order by first, last, key",
    "top_missing": "select first, last from fx_missing_range order by first, last limit 50",
    "validation_summary": """
        select (select count(*) from fx_expected) as expected, (select count(*) from fx_missing_range) as missing,
               (select string_agg(concat(first, '-', last), ',' order by first, last)
                from (select * from fx_missing_range order by first, last limit 50)) as first_missing""",
    "coverage_gaps": """
        with lim as (select min(height) as low, max(height) as high from fx_block),
        clip as (select greatest(first, low) as a, least(last, high) + 1 as z from fx_parsed, lim
                 where last >= low and first <= high),
        step as (select a as p, 1 as s from clip union all select z, -1 from clip
                 union all select low, 0 from lim union all select high + 1, 0 from lim),
        point as (select p, sum(s) as s from step group by p
                  having sum(s) <> 0 or p = (select low from lim) or p = (select high + 1 from lim)),
        seg as (select p as first, lead(p) over (order by p) - 1 as last,
                       cast(sum(s) over (order by p) as bigint) as depth from point)
        select case when depth = 0 then 'gap' else 'overlap' end as kind, first, last, depth
        from seg where last >= first and depth <> 1""",
    "assign_batch": """
        select height, member, height // 1000 * 1000 as batch_start, height // 1000 * 1000 + 999 as batch_end from fx_obj""",
    "batch_stats": """
        select height // 1000 * 1000 as batch_start, height // 1000 * 1000 + 999 as batch_end,
               count(distinct height) as dirs, count(*) as files, cast(sum(size) as bigint) as bytes
        from fx_obj group by 1, 2""",
    "dir_size": "select height, cast(sum(size) as bigint) as bytes from fx_obj group by 1",
    "to_fetch": """
        select height, member, size from fx_shard_obj s where priority = 1 and not exists
          (select 1 from fx_shard_obj l where l.priority = 2 and l.size > 0 and l.height = s.height and l.member = s.member)""",
    "fetch_stats": """
        select s.height, count(*) filter (l.height is null) as files_fetched, count(l.height) as files_skipped,
               cast(coalesce(sum(s.size) filter (l.height is null), 0) as bigint) as bytes_fetched,
               cast(coalesce(sum(l.size), 0) as bigint) as bytes_skipped
        from (select * from fx_shard_obj where priority = 1) s
        left join (select * from fx_shard_obj where priority = 2 and size > 0) l
          on l.height = s.height and l.member = s.member group by 1""",
    "copy_plan": """
        select key, concat('copied/', substr(key, 10)) as dest_key, size from fx_src
        where concat('copied/', substr(key, 10)) not in (select key from fx_dst)""",
    "copy_plan_named": r"""
        select key, concat('copied/', substr(key, 10)) as dest_key, size from fx_archive
        where key like 'archives/%' and regexp_matches(key, '^(?:([^\n]+)/)?([0-9]+)-([0-9]+)\.tar\.(gz|zst)$', 'i')
          and size % 3 <> 0""",
    "copy_counters": r"""
        select count(*) as listed, count(*) filter (not named) as skipped_filter,
               count(*) filter (named and held) as skipped_existing, count(*) filter (named and not held) as copied
        from (select false as named, false as held from fx_src
              union all
              select regexp_matches(key, '^(?:([^\n]+)/)?([0-9]+)-([0-9]+)\.tar\.(gz|zst)$', 'i'), size % 3 = 0
              from fx_archive where key like 'archives/%')""",
    "reconcile_copy": r"""
        select s.key, case when d.key is null then 'missing' when s.size <> d.size then 'size_mismatch'
                           when regexp_matches(d.etag, '^[0-9a-f]{32}$') and s.etag <> d.etag then 'md5_mismatch'
                           else 'ok' end as verdict
        from (select concat('copied/', substr(key, 10)) as key, size, etag from fx_src) s left join fx_dst d on d.key = s.key""",
    "verify_content": """
        select cast(doc_id as varchar) as key,
               case when doc_id % 25 = 1 and strlen(text) <> 0 then 'size_mismatch'
                    when doc_id % 33 = 2 then 'md5_mismatch' else 'ok' end as verdict from documents""",
    "exists_keys": """
        select concat('copied/', substr(key, 10)) as key,
               case when concat('copied/', substr(key, 10)) in (select key from fx_dst) then 'FOUND' else 'MISSING' end as status
        from fx_src""",
    "inventory_totals": """
        select prefix, count(*) as objects, cast(sum(size) as bigint) as bytes
        from (select split_part(key, '/', 1) || '/' || split_part(key, '/', 2) as prefix, size from fx_src)
        group by rollup (prefix)""",
    "common_prefixes": "select distinct concat('archives/', source, '/') as prefix from documents",
    "delete_manifest": """
        select key, (row_number() over (order by md5(key), key) - 1) // 1000 as page from fx_src""",
    "copy_schedule": """
        select key, lane, cast(coalesce(sum(size) over (partition by lane order by md5(key), key
                       rows between unbounded preceding and 1 preceding), 0) * 16 // 5000 as bigint) as slot
        from (select key, size, cast('0x' || substr(md5(key), 25, 8) as bigint) % 16 as lane from fx_src)""",
    "sealed_batches": _SEALED,
    "late_heights": """
        select doc_id as height from labels where doc_id // 1000 * 1000 in (select batch_start from fx_sealed)""",
    "late_heights_stream": """
        select distinct doc_id as height from labels where doc_id // 1000 * 1000 in (select batch_start from fx_sealed)""",
    "open_windows": """
        select event_id // 1000 * 1000 as batch_start, event_id // 1000 * 1000 + 999 as batch_end, count(*) as dirs
        from events group by 1, 2
        having event_id // 1000 * 1000 + 1000 + 100 > (select max(event_id) from events)""",
    "sealed_batches_stream": _SEALED,
    "stream_resume": _SEALED,
    "stream_sink": "select batch_start, dirs from fx_sealed",
    "archive_job": """
        with due as (select first as batch_start, last as batch_end from fx_expected
                     where last = first + 99 and last <= (select greatest(max(event_id) - 100, 0) // 100 * 100 from events)
                       and concat('archives/', first, '-', last, '.tar.zst') not in (select key from fx_archive)),
        rows as (select height, size from fx_sources join fx_winner using (height, priority)
                 union all select height, size from fx_shard_obj
                 where priority = 3 and height not in (select height from fx_sources)),
        got as (select height // 100 * 100 as batch_start, count(distinct height) as dirs, count(*) as files,
                       cast(sum(size) as bigint) as bytes from rows group by 1)
        select batch_start, batch_end, coalesce(dirs, 0) as dirs, coalesce(files, 0) as files, coalesce(bytes, 0) as bytes,
               100 - coalesce(dirs, 0) as empty_heights, case when files > 0 then 'archived' else 'empty' end as status
        from due left join got using (batch_start)""",
    "stage_job": """
        select s.height // 1000 * 1000 as batch_start, s.height // 1000 * 1000 + 999 as batch_end,
               count(distinct s.height) as dirs,
               count(*) filter (l.height is null) as files_fetched, count(l.height) as files_skipped,
               cast(coalesce(sum(s.size) filter (l.height is null), 0) as bigint) as bytes_fetched,
               cast(coalesce(sum(l.size), 0) as bigint) as bytes_skipped
        from (select * from fx_shard_obj where priority = 1) s
        left join (select * from fx_shard_obj where priority = 2 and size > 0) l
          on l.height = s.height and l.member = s.member group by 1, 2""",
    "fix_gaps_job": """
        select height // 100 * 100 as batch_start, count(*) as found,
               count(*) filter (height in (select height from fx_fallback)) as filled,
               count(*) filter (height not in (select height from fx_fallback)) as failed
        from fx_no_block group by 1""",
    "import_job": """
        select doc_id // 100 * 100 as batch_start, count(*) as files, cast(sum(strlen(text)) as bigint) as bytes
        from documents group by 1""",
    "audit_repair_job": """
        with arch as (select first, last, min(key) as key from fx_parsed where last >= 0 group by 1, 2),
        want as (select first, last, unnest(generate_series(first, last)) as height from arch),
        whole as (select *, first % 100 = 0 and last = first + 99 as aligned from want),
        gone as (select first, last, aligned, height from whole
                 where not aligned or height in (select height from fx_miss_h)),
        part as (select w.first, w.last, s.height, s.shard_id from whole w join fx_miss_s s using (height) where aligned),
        left_over as (select first, last from gone
                      where (aligned and height in (select height from fx_after_h))
                         or (not aligned and height not in (select height from fx_fallback))
                      union select w.first, w.last from whole w join fx_after_s s using (height) where aligned),
        sums as (select a.*, (select count(*) from gone g where g.first = a.first and g.last = a.last) as missing_heights,
                        (select count(*) from part p where p.first = a.first and p.last = a.last) as missing_shards from arch a)
        select key as archive_key, first as batch_start, last as batch_end, missing_heights, missing_shards,
               case when missing_heights + missing_shards = 0 then 'ok'
                    when exists (select 1 from left_over l where l.first = s.first and l.last = s.last) then 'incomplete'
                    else 'repaired' end as status
        from sums s""",
    "validate_job": """
        with lim as (select 0 as low, max(height) as high from fx_block),
        clip as (select greatest(first, low) as a, least(last, high) + 1 as z from fx_parsed, lim
                 where last >= low and first <= high),
        step as (select a as p, 1 as s from clip union all select z, -1 from clip
                 union all select low, 0 from lim union all select high + 1, 0 from lim),
        point as (select p, sum(s) as s from step group by p
                  having sum(s) <> 0 or p = (select low from lim) or p = (select high + 1 from lim)),
        seg as (select p as first, lead(p) over (order by p) - 1 as last, sum(s) over (order by p) as depth from point)
        select (select count(*) from fx_expected) as expected, (select count(*) from fx_missing_range) as missing,
               (select string_agg(concat(first, '-', last), ',' order by first, last)
                from (select * from fx_missing_range order by first, last limit 50)) as first_missing,
               (select cast(coalesce(sum(n), 0) as bigint) from (select count(*) as n from fx_parsed group by first, last having count(*) > 1)) as duplicates,
               (select count(*) from seg where last >= first and depth = 0) as gaps,
               (select count(*) from seg where last >= first and depth > 1) as overlaps""",
    "copy_job": r"""
        with after as (
            select key, size, etag from fx_dst
            union all
            select concat('copied/', substr(key, 10)), size, etag from fx_src
            where concat('copied/', substr(key, 10)) not in (select key from fx_dst)
              and cast(regexp_extract(key, '[0-9]+$') as bigint) % 7 <> 3
        ), v as (select s.key, b.key as held,
                     case when d.key is null then 'missing' when s.size <> d.size then 'size_mismatch'
                          when regexp_matches(d.etag, '^[0-9a-f]{32}$') and s.etag <> d.etag then 'md5_mismatch'
                          else 'ok' end as verdict
                   from (select concat('copied/', substr(key, 10)) as key, size, etag from fx_src) s
                   left join fx_dst b on b.key = s.key left join after d on d.key = s.key)
        select count(*) as listed, cast(0 as bigint) as skipped_filter, count(held) as skipped_existing,
               count(*) - count(held) as copied, count(*) filter (verdict = 'ok') as ok,
               count(*) filter (verdict = 'missing') as missing,
               count(*) filter (verdict = 'size_mismatch') as size_mismatch,
               count(*) filter (verdict = 'md5_mismatch') as md5_mismatch from v""",
    "copy_job_dry_run": """
        select key, concat('copied/', substr(key, 10)) as dest_key, size from fx_src
        where concat('copied/', substr(key, 10)) not in (select key from fx_dst)""",
    "pack_job": """
        select concat(b, '-', b + 99) as batch, cast(bytes // 1048576 as bigint) as uncompressed_mb, dirs, true as timed
        from (select doc_id // 100 * 100 as b, sum(strlen(text)) as bytes, count(*) as dirs from documents group by 1)""",
    "fix_gaps_from_replies": """
        with lost as (
            select height, height % 7 <> 1 and height in (select height from fx_block) as known,
                   height % 3 <> 0 and height % 5 <> 0
                   or height % 3 = 0 and height not in (select height from fx_wanted_shard) as sound
            from fx_no_block
        )
        select height // 100 * 100 as batch_start, count(*) as found,
               count(*) filter (known and sound) as filled, count(*) filter (not (known and sound)) as failed
        from lost group by 1""",
    "copy_objects": "select distinct doc_id // 100 * 100 as batch_start, true as ok from documents",
    "exists_job": """
        select concat('archives/', first, '-', last, '.tar.zst') as key,
               case when concat('archives/', first, '-', last, '.tar.zst') in (select key from fx_archive)
                    then 'FOUND' else 'MISSING' end as status from fx_expected""",
    "purge_plan_job": """
        select page, count(*) as objects, cast(sum(size) as bigint) as bytes
        from (select size, (row_number() over (order by md5(key), key) - 1) // 1000 as page from fx_src) group by 1""",
    "stream_gap_counts": "select batch_start, batch_end, dirs as seen, 1000 - dirs as missing from fx_sealed",
}


def _needed(sql: str) -> list[str]:
    """Views a statement uses, in definition order."""
    used: set[str] = set()
    text = [sql]
    while text:
        body = text.pop()
        for name, definition in VIEWS.items():
            if name in body and name not in used:
                used.add(name)
                text.append(definition)
    return [name for name in VIEWS if name in used]


def statement(name: str) -> str:
    """The whole SQL of a query, its views as common table expressions."""
    sql = ORACLES[name]
    views = ",\n".join(f"{view} as {'materialized ' * (view in SHARED)}({VIEWS[view]})" for view in _needed(sql))
    return f"with {views}\nselect * from ({sql})" if views else sql


def statements() -> dict[str, str]:
    return {name: statement(name) for name in ORACLES}
