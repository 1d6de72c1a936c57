"""DuckDB SQL that is put together from parts."""

from __future__ import annotations

_STATE = "struct(c bigint, a varchar, t varchar[])"


def _least(*states: str) -> str:
    """Of those that there are, the one with the least cost, then the least edits."""
    return f"list_sort(list_filter([{', '.join(states)}], lambda x: x is not null))[1]"


def _edited(state: str, price: str, edit: str, line: str | None = None, when: str = "true") -> str:
    text = f"{state}.t" if line is None else f"list_append({state}.t, {line})"
    return f"(case when {state} is not null and {when} then struct_pack(c := {state}.c + {price}, a := {state}.a || '{edit}', t := {text}) end)"


def _closed() -> str:
    """The states with empty turns inserted behind them."""
    user = _least("s2", *(_edited(s, "3", "I", "'user:'") for s in ("s0", "s1", "s3")))
    return f"s0 as e0, s1 as e1, {user} as e2, {_least('s3', _edited(user, '3', 'I', chr(39) + 'assistant:' + chr(39)))} as e3"


def _stepped() -> str:
    gone = [_edited(f"e{k}", "4", "D") for k in range(4)]
    kept = lambda s, letter: _edited(s, "cut", "K", "role || ':' || text", f"not must and letter = '{letter}'")
    turned = lambda s, role: _edited(s, "3 + cut", "R", f"'{role}:' || text", "not must")
    user = [f(s) for s in ("e0", "e1", "e3") for f in (lambda s: kept(s, "u"), lambda s: turned(s, "user"))]
    new = [gone[0], _least(gone[1], kept("e0", "s")), _least(gone[2], *user), _least(gone[3], kept("e2", "a"), turned("e2", "assistant"))]
    return ", ".join(f"cast({n} as {_STATE}) as s{k}" for k, n in enumerate(new))


#: Damage by a CRC-32 taken bit by bit, then one step of the dynamic programme per turn for all conversations, with the whole edits and texts in the states.
REPAIR = rf"""
    with recursive filled as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k from conversations
    ), summed as (
        select *, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(range(1, length(k) + 1), lambda i: cast(ascii(k[i]) as bigint))),
            lambda x, y: list_reduce(list_prepend(xor(x, y), range(8)), lambda p, q: xor(p >> 1, 3988292384 * (p & 1))))) % 20 as kind from filled
    ), damaged as (
        select conv_id, turn, case when kind = 4 then 'user' else role end as role,
            case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(case when kind = 3 then [0, 1] else [0] end) as nth
        from summed where kind <> 0
    ), placed as (
        select *, row_number() over (partition by conv_id order by turn nulls first, md5(length(role) || ':' || role || text), nth) as rn from damaged
    ), faulty as (
        select *, case when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else 'x' end as letter, not regexp_matches(text, '[^\x20\x09-\x0D]') as is_blank,
            row_number() over (partition by conv_id, role, text order by rn) > 1 as again, not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') as is_cut from placed
    ), turns as (
        select conv_id, rn, turn, role, text, letter, is_blank, again and not is_blank as is_dup, is_cut and not again and not is_blank as is_trunc, is_blank or again as must, case when is_cut then 3 else 0 end as cut,
            lag(letter) over (partition by conv_id order by rn) || letter as two from faulty
    ), counts as (
        select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (is_blank) as blank, count(*) filter (is_dup) as duplicate,
            count(*) filter (is_trunc) as truncated, count(*) filter (two not in ('su', 'ua', 'au')) as illegal from turns group by conv_id
    ), dp as (
        select conv_id, cast(0 as bigint) as i, cast(struct_pack(c := 0, a := '', t := []) as {_STATE}) as s0, cast(null as {_STATE}) as s1, cast(null as {_STATE}) as s2, cast(null as {_STATE}) as s3 from counts
        union all
        select conv_id, i, {_stepped()} from (
            select d.conv_id, d.i + 1 as i, {_closed()}, t.role, t.text, t.letter, t.must, t.cut from dp d join turns t on t.conv_id is not distinct from d.conv_id and t.rn = d.i + 1)
    ), ended as (
        select conv_id, {_least("e0", "e3")} as best from (select d.conv_id, {_closed()} from dp d join counts c on c.conv_id is not distinct from d.conv_id and c.n = d.i)
    )
    select o.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate, coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal,
        coalesce(e.best.c, 0) as cost, coalesce(e.best.a, '') as audit, sha256(coalesce(array_to_string(e.best.t, chr(10)), '')) as repaired_sha256
    from (select distinct conv_id from conversations) o left join counts c on c.conv_id is not distinct from o.conv_id left join ended e on e.conv_id is not distinct from o.conv_id"""
