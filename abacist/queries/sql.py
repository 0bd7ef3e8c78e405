"""SQL text of single functions, for the DuckDB check.

RE2 has no Unicode flag: digits are ``\\p{Nd}`` and spaces ``[\\s\\p{Z}]``.
"""

from __future__ import annotations

from abacist.constants import DEFAULT_SEED

SP = r"[\s\p{Z}]"
NUM = r"-?\p{Nd}+\.?\p{Nd}*"
INT = r"\p{Nd}+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(t: str) -> str:
    return rf"regexp_replace({t}, '^{SP}+|{SP}+$', '', 'g')"


def blank(t: str) -> str:
    return f"coalesce({strip(t)} = '', true)"


def has_marker(t: str) -> str:
    return f"regexp_matches({t}, '答案[：:]')"


def extract(t: str) -> str:
    return rf"""coalesce(nullif(regexp_extract({t}, '答案[：:]{SP}*({NUM})', 1), ''),
        regexp_extract_all({t}, '{NUM}')[-1], '')"""


def hash32(key: str, salt: str = "''", seed: int = DEFAULT_SEED) -> str:
    return f"cast('0x' || substr(md5(concat({key}, '|', {salt}, '|{seed}')), 1, 8) AS BIGINT)"


def _equation(op: str, group: int, t: str) -> str:
    pattern = rf"({INT}){SP}*({op}){SP}*({INT}){SP}*={SP}*({INT})"
    return f"regexp_extract_all({t}, '{pattern}', {group})[-1]"


def stated(t: str) -> str:
    ops = ("/", "[+-]", "[×x*]")
    parts = ", ".join(_equation(op, 4, t) for op in ops)
    return rf"""CAST(CAST(coalesce({parts},
        nullif(regexp_extract({t}, '答案[：:]{SP}*({INT})', 1), '')) AS HUGEINT) AS VARCHAR)"""


def holds(t: str) -> str:
    def side(op: str, group: int) -> str:
        return f"CAST({_equation(op, group, t)} AS BIGINT)"

    div = [side("/", g) for g in (1, 3, 4)]
    add = [side("[+-]", g) for g in (1, 3, 4)]
    mul = [side("[×x*]", g) for g in (1, 3, 4)]
    return f"""CASE WHEN {div[2]} IS NOT NULL THEN {div[1]} <> 0 AND {div[1]} * {div[2]} = {div[0]}
        WHEN {add[2]} IS NOT NULL THEN CASE WHEN {_equation("[+-]", 2, t)} = '+'
            THEN {add[0]} + {add[1]} = {add[2]} ELSE {add[0]} - {add[1]} = {add[2]} END
        WHEN {mul[2]} IS NOT NULL THEN {mul[0]} * {mul[1]} = {mul[2]} END"""


def number(t: str) -> str:
    """Decimal or fraction as double."""
    return f"""CASE len(string_split({t}, '/'))
        WHEN 1 THEN try_cast({t} AS DOUBLE)
        WHEN 2 THEN try_cast(string_split({t}, '/')[1] AS DOUBLE)
            / nullif(try_cast(string_split({t}, '/')[2] AS DOUBLE), 0) END"""


def reward(response: str, truth: str) -> str:
    given, wanted = number(extract(response)), number(extract(truth))
    return f"""(CASE WHEN abs(({given}) - ({wanted})) < 0.01 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
        + CASE WHEN regexp_matches({response}, '步骤|先|再|然后|因此|所以')
            THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END
        + CASE WHEN {has_marker(response)} THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END)"""


def answer_line(cot: str, answer: str) -> str:
    cot = f"coalesce({cot}, '')"
    last = rf"regexp_extract_all({cot}, '\p{{Nd}}+(?:\.\p{{Nd}}+)?')[-1]"
    return f"""CASE WHEN {has_marker(cot)} OR {answer} IS NULL THEN {cot}
        WHEN {last} = {strip(answer)} THEN {cot}
        ELSE {cot} || chr(10) || '答案：' || {answer} END"""


def repaired(t: str, answer: str) -> str:
    t = f"coalesce({t}, '')"
    line = rf"(?m)答案[：:]{SP}*[\s\S]*?{SP}*$"
    first = f"regexp_extract({strip(t)}, '{line}')"
    stated_value = strip(f"string_split(string_split({first}, '：')[-1], ':')[-1]")
    return f"""CASE WHEN {answer} IS NULL THEN {t}
        WHEN NOT {has_marker(t)} THEN {strip(t)} || chr(10) || '答案：' || {answer}
        WHEN {stated_value} = {strip(answer)} THEN {t}
        ELSE regexp_replace({strip(t)}, '{line}', '答案：' || {answer}, 'g') END"""


def marked_token(t: str) -> str:
    return rf"coalesce(nullif(regexp_extract({t}, '答案[：:]{SP}*([^\s\p{{Z}}]+)', 1), ''), '0')"


def code_points(t: str) -> str:
    return f"""CASE WHEN {t} = '' THEN []::INTEGER[]
        ELSE list_transform(string_split({t}, ''), lambda c: unicode(c)) END"""


def ids_text(ids: str) -> str:
    return f"array_to_string({ids}, ',')"


def chat(*turns: tuple[str, str]) -> str:
    parts = []
    for role, content in turns:
        parts += [quoted(f"<|im_start|>{role}\n"), content, quoted("<|im_end|>\n")]
    return f"concat({', '.join(parts)})"


def loss_terms(cur: str, old: str, adv: str) -> tuple[str, str]:
    """Loss and KL of one rollout from list columns and one advantage."""
    n = f"least(len({cur}), len({old}))"
    pairs = f"list_zip({cur}[1:{n}], {old}[1:{n}])"
    ratio = "exp(z[1] - z[2])"
    objective = f"least({ratio} * {adv}, greatest(least({ratio}, 1.2::DOUBLE), 0.8::DOUBLE) * {adv})"
    surrogate = f"list_avg(list_transform({pairs}, lambda z: {objective}))"
    kl = f"list_avg(list_transform({pairs}, lambda z: z[2] - z[1]))"
    return f"(-{surrogate} + 0.04::DOUBLE * {kl})", kl
