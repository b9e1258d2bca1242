"""DuckDB SQL for the operators that SQL can express, written independently of them."""

from __future__ import annotations

from fieldbook.llm.decontaminate import MATCHING, SHORTEST, SPAN, WINDOW
from fieldbook.llm.license_scan import COVER, NOTICES, PHRASES, REACH
from fieldbook.llm.suffix_dedup import LENGTH

ASCII_WORDS = r"list_filter(string_split_regex(coalesce({0}, ''), '[ \t\n\x0b\f\r]+'), lambda w: w <> '')"
LOWER_WORDS = (
    r"list_filter(string_split_regex(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
)

JACCARD_JOIN = f"""
    with recursive texts as (
      select coalesce(text, '') as text, min(doc_id) as node, count(*) as copies, {ASCII_WORDS.format('text')} as w from documents group by text),
    sets as (select node, copies, list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) as s
             from texts where len(w) > 0),
    grams as (select node, unnest(s) as g from sets),
    shared as (select a.node as a, b.node as b, count(*) as n from grams a join grams b on a.g = b.g and a.node <> b.node group by 1, 2),
    links as (select sh.a, sh.b from shared sh join sets x on x.node = sh.a join sets y on y.node = sh.b
              where 5 * sh.n >= 4 * (len(x.s) + len(y.s) - sh.n)),
    reach(a, b) as (select node, node from texts union select r.a, l.b from reach r join links l on l.a = r.b),
    class_of as (select a as node, min(b) as class_id from reach group by a),
    counted as (select l.a as node, sum(t.copies) as n from links l join texts t on t.node = l.b group by 1)
    select d.doc_id, c.class_id, t.copies, (coalesce(k.n, 0) + t.copies - 1)::bigint as n_links
    from documents d join texts t on t.text = coalesce(d.text, '') join class_of c on c.node = t.node left join counted k on k.node = t.node"""

DECONTAMINATION = f"""
    with docs as (select doc_id, {LOWER_WORDS.format('text')} as w from documents),
    items as (select w, min(item_id) as item_id from (select item_id, {LOWER_WORDS.format('text')} as w from benchmark) group by w having len(w) >= {SHORTEST}),
    here as (select doc_id, len(w) as n, unnest(w) as word, generate_subscripts(w, 1) - 1 as pos from docs),
    there as (select item_id, len(w) as size, least(len(w), {WINDOW}) as width, case when len(w) < {SPAN} then 1.0 else {MATCHING} end as share, unnest(w) as word, generate_subscripts(w, 1) - 1 as spot from items),
    same as (select doc_id, item_id, size, width, share, n, pos - spot as diagonal, spot from here join there using (word)),
    diagonals as (select doc_id, item_id, diagonal, any_value(size) as size, any_value(width) as width, any_value(share) as share, any_value(n) as n, list(spot) as ats
                  from same group by 1, 2, 3 having count(*) >= any_value(share) * any_value(width)),
    starts as (select *, unnest(range(greatest(-diagonal, 0), least(size, n - diagonal) - width + 1)) as s from diagonals),
    good as (select doc_id, item_id, diagonal, width, ats, min(s) as first, max(s) as last from starts
             where len(list_filter(ats, lambda a: a >= s and a < s + width)) >= share * width group by all)
    select doc_id, item_id, count(*) as n_places, min(diagonal + first)::bigint as first_word, max(last - first + width)::bigint as n_words,
           max(len(list_filter(ats, lambda a: a >= first and a < last + width)))::bigint as n_same
    from good group by 1, 2"""

SUFFIX_DEDUP = f"""
    with docs as (select doc_id, encode(coalesce(text, '')) as raw from documents),
    strings as (select doc_id, unnest(range(0, greatest(octet_length(raw) - {LENGTH - 1}, 0))) as spot from docs),
    cut as (select s.doc_id, s.spot, d.raw[s.spot + 1:s.spot + {LENGTH}] as string from strings s join docs d using (doc_id)),
    firsts as (select string, min(doc_id) as first_id from cut group by 1),
    repeats as (select c.doc_id, c.spot from cut c join firsts f using (string) where f.first_id < c.doc_id),
    runs as (select doc_id, spot, sum(coalesce((spot > before + {LENGTH})::int, 1)) over (partition by doc_id order by spot) as run
             from (select *, lag(spot) over (partition by doc_id order by spot) as before from repeats)),
    gone as (select doc_id, min(spot) as a, max(spot) + {LENGTH} as b from runs group by doc_id, run),
    pieces as (select doc_id, a as piece, coalesce(lag(b) over (partition by doc_id order by a), 0) as from_, a as until from gone
               union all select d.doc_id, 9223372036854775807, coalesce(max(b), 0), octet_length(any_value(d.raw)) from docs d left join gone g using (doc_id) group by d.doc_id),
    kept as (select p.doc_id, string_agg(hex(d.raw[p.from_ + 1:p.until]), '' order by piece) as h from pieces p join docs d using (doc_id) group by 1),
    counts as (select doc_id, sum(b - a)::bigint as n, count(*) as spans from gone group by 1)
    select d.doc_id, octet_length(d.raw)::bigint as n_bytes, coalesce(c.n, 0) as n_removed, coalesce(c.spans, 0) as n_spans, sha256(unhex(k.h)) as kept_sha256
    from docs d join kept k using (doc_id) left join counts c using (doc_id)"""


def template_rows() -> str:
    rows = []
    templates = [(label, text, text, True) for text, label in PHRASES.items()] + [(*notice, False) for notice in NOTICES]
    for number, (label, key, text, phrase) in enumerate(templates):
        words, before = text.split(), text[: text.index(key)].count(" ")
        for at in range(len(words) - 1):
            must = before <= at < before + key.count(" ")
            rows.append(f"({number}, '{label}', {phrase}, {len(words) - 1}, {key.count(' ')}, {at}, {must}, '{words[at]} {words[at + 1]}')")
    return ", ".join(rows)


LICENSE_SCAN = f"""
    with templates(template, label, phrase, pairs, needed, spot, must, gram) as (values {template_rows()}),
    docs as (select doc_id, {LOWER_WORDS.format('text')} as w from documents),
    grams as (select doc_id, unnest(range(0, len(w) - 1)) as pos, w from docs where len(w) > 1),
    hits as (select g.doc_id, t.*, g.pos - t.spot as diagonal from (select doc_id, pos, w[pos + 1] || ' ' || w[pos + 2] as gram from grams) g join templates t using (gram)),
    voted as (select doc_id, template, diagonal, count(*) filter (must) as keys from hits group by 1, 2, 3),
    spans as (select *, sum(coalesce((diagonal - before > {REACH})::int, 0)) over (partition by doc_id, template order by diagonal) as span
              from (select *, lag(diagonal) over (partition by doc_id, template order by diagonal) as before from voted)),
    notices as (select h.doc_id, h.label, count(distinct h.spot) / any_value(h.pairs) as covered, max(s.keys) as keys, any_value(h.needed) as needed
                from hits h join spans s using (doc_id, template, diagonal) where not h.phrase group by h.doc_id, h.template, h.label, s.span),
    phrases as (select doc_id, label, diagonal as start, 1.0 as covered from hits where phrase group by doc_id, label, template, diagonal having count(*) = any_value(pairs)),
    found as (select doc_id, label, start, true as base, covered from phrases
              union all select doc_id, label, null, false, covered from notices where covered >= {COVER} and keys >= needed),
    told as (select doc_id, count(*) filter (base) as n_base, min(start) as first_word, max(start) as last_word,
                    string_agg(distinct label, ',' order by label) filter (base) as base_labels, string_agg(distinct label, ',' order by label) as labels,
                    max(covered)::double as score, count(*) filter (not base) as n_notices from found group by 1)
    select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_base, 0) as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
           coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score, coalesce(n_notices, 0) as n_notices
    from docs d left join told using (doc_id)"""


# The checksum of a list of bytes by the usual table of 256 words, which the query builds.
CRC_TABLE = """
    crc_steps(i, step, c) as (select range, 0, range from range(256) union all
      select i, step + 1, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end from crc_steps where step < 8),
    crc_table as (select list(c order by i) as words from crc_steps where step = 8)"""


def crc32(text: str) -> str:
    """Of ASCII text; ``words`` of ``crc_table`` must be in reach."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), lambda a, b: xor(a // 256, words[(xor(a, b) & 255) + 1])), 4294967295)"


def _part(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_part(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MERKLE_MANIFEST = f"""
    with recursive {CRC_TABLE},
    leaves as (select row_number() over (order by source nulls first, doc_id nulls first) as id, dense_rank() over (order by source nulls first) as g,
                      row_number() over (partition by source order by doc_id nulls first, {_leaf('text')}) - 1 as place, doc_id, {_leaf('text')} as leaf,
                      case when {crc32('doc_id::varchar')} % 2 = 0 then {_leaf("replace(text, chr(10), '')")} else {_leaf('text')} end as other
               from documents, crc_table),
    low(g, level, place, h, n) as (select g, 0, place, leaf, count(*) over (partition by g) from leaves
      union all select g, any_value(level) + 1, place // 3, sha256(string_agg(h, '' order by place)), (any_value(n) + 2) // 3 from low where n > 1 group by g, place // 3),
    subroots as (select g, level as top, h as subroot from low where n = 1),
    high(level, place, h, n) as (select 0, row_number() over (order by g) - 1, subroot, count(*) over () from subroots
      union all select any_value(level) + 1, place // 3, sha256(string_agg(h, '' order by place)), (any_value(n) + 2) // 3 from high where n > 1 group by place // 3),
    root as (select h as root from high where n = 1),
    steps as (select id, level, l.place // (3 ** level)::bigint as own, leaf, other, g, 0 as tree from leaves l join subroots s using (g), range(s.top) t(level)
              union all select id, level + 1000, (l.g - 1) // (3 ** level)::bigint, leaf, other, g, 1 from leaves l, (select level from high where n > 1 group by level)),
    nodes as (select g, level, place, h, 0 as tree from low union all select null, level + 1000, place, h, 1 from high),
    pairs as (select s.id, s.level, s.own, coalesce(string_agg(n.h, '' order by n.place) filter (n.place < s.own), '') as before,
                     coalesce(string_agg(n.h, '' order by n.place) filter (n.place > s.own), '') as after
              from steps s join nodes n on n.tree = s.tree and n.level = s.level and n.place // 3 = s.own // 3 and (s.tree = 1 or n.g = s.g) group by all),
    proofs as (select id, list(struct_pack(b := before, a := after) order by level) as proof from pairs group by id),
    fold(id, i, h, proof) as (select id, 0, other, proof from leaves left join proofs using (id)
      union all select id, i + 1, sha256(proof[i + 1].b || h || proof[i + 1].a), proof from fold where i < coalesce(len(proof), 0)),
    done as (select id, h from fold where i = coalesce(len(proof), 0))
    select l.doc_id, l.leaf, s.subroot, r.root, sha256(coalesce(array_to_string(list_transform(p.proof, lambda x: x.b || x.a), ''), '')) as proof_sha256,
           d.h as folded_root, d.h = r.root as verified
    from leaves l join subroots s using (g) join done d using (id) left join proofs p using (id), root r"""


def edit_rows() -> str:
    """(initial, must go, state before, state after, letters, cost): up to two inserts, then the row's edit; states 0 none, 1 s, 2 u, 3 a."""
    turn = {0: "u", 1: "u", 2: "a", 3: "u"}
    state_of = {"u": 2, "a": 3}
    rows = []
    for start in range(4):
        state, letters = start, ""
        for _ in range(3):
            for initial in "sua-":
                rows.append((initial, state, letters + "D", start, state, 2 * len(letters) + 3, True))
                if initial == turn[state]:
                    rows.append((initial, state, letters + "K", start, state_of[initial], 2 * len(letters), False))
                if initial == "s" and state == 0:
                    rows.append((initial, state, letters + "K", start, 1, 2 * len(letters), False))
                rows.append((initial, state, letters + "R", start, state_of[turn[state]], 2 * len(letters) + 2, False))
            state, letters = state_of[turn[state]], letters + "I"
    return ", ".join(f"('{i}', {gone}, {start}, {after}, '{letters}', {cost})" for i, _, letters, start, after, cost, gone in rows)


CONVERSATION_REPAIR = rf"""
    with recursive {CRC_TABLE},
    lots as (select conv_id, coalesce(conv_id::varchar, ' ') as conv, turn, coalesce(role, ' ') as role, coalesce("text", ' ') as "text",
                    {crc32("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as lot from conversations, crc_table),
    hurt as (select conv, turn, case when lot = 4 then 'user' else role end as role,
                    case lot when 1 then '' when 2 then regexp_replace("text", '[.!?]', '', 'g') else "text" end as "text", unnest(range(case when lot = 3 then 2 else 1 end)) as copy
             from lots where lot <> 0),
    numbered as (select *, row_number() over (partition by conv order by turn nulls first, role, "text") as i from hurt),
    faulty as (select *, left(role, 1) as initial, case when not regexp_matches("text", '[^\x20\x09-\x0D]') then 'b'
                         when row_number() over (partition by conv, role, "text" order by i) > 1 then 'd'
                         when not regexp_matches("text", '[.!?][\x20\x09-\x0D]*$') then 't' else '-' end as fault,
                      lag(left(role, 1)) over (partition by conv order by i) as initial_before, max(i) over (partition by conv) as n from numbered),
    edits(initial, gone, start, after, letters, cost) as (values {edit_rows()}),
    walk(conv, i, state, told) as (select distinct conv, 0::bigint, 0, '000000000' from faulty
      union all select w.conv, any_value(f.i), e.after, min(lpad((substr(told, 1, 9)::bigint + e.cost + case when f.fault = 't' and not e.gone then 1 else 0 end)::varchar, 9, '0') || substr(told, 10) || e.letters)
      from walk w join faulty f on f.conv = w.conv and f.i = w.i + 1
      join edits e on e.start = w.state and e.initial = case when f.initial in ('s', 'u', 'a') then f.initial else '-' end and (e.gone or f.fault not in ('b', 'd'))
      group by w.conv, e.after),
    ends(state, letters, cost) as (values (0, '', 0), (0, 'II', 4), (1, 'II', 4), (2, 'I', 2), (3, '', 0), (3, 'II', 4)),
    best as (select w.conv, min(lpad((substr(told, 1, 9)::bigint + e.cost)::varchar, 9, '0') || substr(told, 10) || e.letters) as told
             from walk w join ends e using (state) join (select conv, max(i) as n from faulty group by 1) c on c.conv = w.conv and c.n = w.i group by 1),
    letters as (select conv, told, unnest(string_split(substr(told, 10), '')) as letter, generate_subscripts(string_split(substr(told, 10), ''), 1) as p from best where length(told) > 9),
    aligned as (select *, count(*) filter (letter <> 'I') over (partition by conv order by p) as i from letters),
    outs as (select a.conv, a.p, a.letter, f.role, f."text", coalesce(a.letter = 'K' and f.initial = 's', false) as leads
             from aligned a left join faulty f on f.conv = a.conv and f.i = a.i and a.letter <> 'I' where a.letter <> 'D'),
    ranked as (select *, row_number() over (partition by conv order by p) - max(leads::int) over (partition by conv) as turn_no from outs),
    lines as (select conv, p, case when letter = 'K' then role when turn_no % 2 = 1 then 'user' else 'assistant' end || ':' || coalesce("text", '') as line from ranked),
    repaired as (select conv, string_agg(line, chr(10) order by p) as whole from lines group by 1),
    counts as (select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
                      count(*) filter (fault = 't') as truncated, count(*) filter (i > 1 and initial_before || initial not in ('su', 'ua', 'au')) as illegal from faulty group by 1)
    select l.conv_id, coalesce(c.gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
           coalesce(illegal, 0) as illegal, coalesce(substr(told, 1, 9)::bigint, 0) as cost, coalesce(substr(told, 10), '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
    from (select distinct conv_id, conv from lots) l left join counts c using (conv) left join best using (conv) left join repaired using (conv)"""
