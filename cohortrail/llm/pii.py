"""Keyed surrogates for personal data, in DataFrame and SQL expressions only.

Detected are e-mail addresses, phone numbers, IPv4 addresses, card numbers (by check digit), social security numbers,
and names after a title. Each entity has a canonical form (digits of a number, lower-case address, a word of a name);
its surrogate is derived from a key and that form alone, so that the same entity gets the same surrogate wherever and
in whatever format it stands. Surrogates keep the type, the format (separators, number of digits, case), the check
digit, the top-level domain, the script and, for given names, the gender that the title tells.

Collisions are checked over all entities of a type: a surrogate that two entities would share, or that is an entity
itself, goes to the first of them or to none, and the others draw again, from a larger space with each attempt.

Null or empty text: unchanged. Texts without an entity: unchanged, and never shuffled. Repeated rows: each is
rewritten. Very long texts: whole. All other columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.llm import common
from cohortrail.operators.skew import materialize

KEY = "surrogates"

# Titles by gender, and names by gender and script (fixed values).
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"],
    "n": ["Dr", "Prof", "Doktor", "Docteur", "Доктор"],
}
GIVEN = {
    ("m", "latin"): "Adam Boris Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Nils Oscar Paul".split(),
    ("f", "latin"): "Anna Berta Clara Dora Emma Flora Greta Helena Ida Julia Karin Laura Maria Nora Olga Paula".split(),
    ("n", "latin"): "Alex Chris Dana Jamie Kim Luca Mika Noel Robin Sam Sascha Toni".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Максим Олег Павел Семён".split(),
    ("f", "cyrillic"): "Алла Вера Галина Дарья Елена Жанна Ирина Лариса Мария Нина Ольга Юлия".split(),
    ("n", "cyrillic"): "Саша Женя Валя Слава".split(),
}
SURNAME = {
    "latin": ("Al Ber Cor Dal El Fer Gal Har Kel Lan Mor Nor Pel Ros Sel Tor".split(),
              "an en in on ar er or el".split(),
              "berg dorf field holm land man mont ner ridge sen son stone tal wald well wood".split()),
    "cyrillic": ("Ал Бел Вол Гор Дуб Зим Ков Лес Мор Орл Пол Сок".split(), "ан ен ин он".split(),
                 "енко ич ук чук як".split()),
}

_WORD = r"\p{Lu}\p{Ll}+(?:['’-]\p{Lu}\p{Ll}+)*"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*(?<=\.[A-Za-z]{2,24})"
IP = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = (
    r"(?<![\p{L}\d+])\+?\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<![\p{L}\d+])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\p{L}\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){3,5}(?!\d)"
    r"|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
)
CARD = r"(?<![\d])\d(?:[ -]?\d){12,18}(?!\d)"
TITLE = rf"(?<!\p{{L}})(?:{'|'.join(t for ts in TITLES.values() for t in ts)})\.? "
NAME = rf"{TITLE}{_WORD}(?: {_WORD}){{0,2}}"
ENTITY = "|".join((EMAIL, PHONE, IP, SSN, CARD, NAME))
#: What any entity holds; texts without it need no closer look.
HINT = rf"[@]|\d[ .-]?\d|{TITLE}"


def _sql(pattern: str) -> str:
    """A pattern as an SQL string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _words(values: list[str]) -> str:
    return f"array({', '.join(_sql(v) for v in values)})"


_DIGITS = "regexp_replace({0}, '[^0-9]', '')"


def _kind(m: str) -> str:
    """Type of a match; null for digits that are no card number."""
    whole = {name: _sql(f"^(?:{p})$") for name, p in (("ip", IP), ("ssn", SSN), ("phone", PHONE))}
    return (
        f"CASE WHEN contains({m}, '@') THEN 'email' WHEN {m} RLIKE '^\\\\p{{L}}' THEN 'name' "
        + "".join(f"WHEN {m} RLIKE {pattern} THEN '{name}' " for name, pattern in whole.items())
        + f"WHEN luhn_check({_DIGITS.format(m)}) THEN 'card' END"
    )


def _parts() -> str:
    """Parts of the match `m` of kind `kind`: (type, value); a null type stays as it is."""
    title = f"regexp_extract(m, {_sql('^' + TITLE)}, 0)"
    bare = f"regexp_replace({title}, '[. ]', '')"
    gender = "CASE " + " ".join(
        f"WHEN array_contains({_words(t)}, {bare}) THEN '{g}'" for g, t in TITLES.items()
    ) + " END"
    words = f"split(substr(m, length({title}) + 1), ' ')"
    part = "named_struct('type', {0}, 'value', {1})"
    keep = part.format("CAST(NULL AS string)", "{0}")
    word = part.format(f"IF(i = size({words}) - 1, 'surname', concat('given_', {gender}))", "w")
    return (
        f"CASE WHEN kind = 'name' THEN concat(array({keep.format(title)}), flatten(transform({words}, (w, i) -> "
        f"IF(i = 0, array({word}), array({keep.format(repr(' '))}, {word}))))) "
        f"ELSE array({part.format('kind', 'm')}) END"
    )


CANONICAL = (
    f"CASE WHEN type IN ('phone', 'card', 'ssn') THEN {_DIGITS.format('value')} "
    "WHEN type = 'email' THEN lower(value) ELSE value END"
)


def _draw(seed: str, i: str, n: str | int) -> str:
    return f"CAST(pmod(xxhash64({seed}, {i}), {n}) AS int)"


def _shape(text: str, seed: str) -> str:
    """Letters and digits of `text` drawn anew, all else as it is."""
    letter = f"substr('abcdefghijklmnopqrstuvwxyz', {_draw(seed, 'i', 26)} + 1, 1)"
    drawn = (
        f"CASE WHEN c RLIKE '[0-9]' THEN CAST({_draw(seed, 'i', 10)} AS string) "
        f"WHEN c RLIKE '\\\\p{{L}}' THEN {letter} ELSE c END"
    )
    return f"array_join(transform(split({text}, ''), (c, i) -> {drawn}), '')"


def _pick(words: list[str], seed: str, i: str) -> str:
    return f"element_at({_words(words)}, {_draw(seed, i, len(words))} + 1)"


def _propose(key: str) -> str:
    """Surrogate of `canonical` of `type` at an `attempt`; `seed` depends on the key and all three."""
    host = "regexp_replace(substring_index(canonical, '@', -1), '[.][a-z]+$', '')"
    top = "regexp_extract(canonical, '[.][a-z]+$', 0)"
    more = "IF(attempt > 7, {0}, '')"
    local, longer = "substring_index(canonical, '@', 1)", "repeat('x', attempt - 7)"
    email = (
        f"concat({_shape(local, 'seed')}, {more.format(_shape(longer, 'sha2(seed, 256)'))}, "
        f"'@', {_shape(host, f'sha2(concat({_sql(key)}, {host}), 256)')}, {top})"
    )
    octet = (
        f"CASE WHEN attempt > 7 THEN {_draw('seed', 'i', 256)} WHEN length(o) = 1 THEN {_draw('seed', 'i', 10)} "
        f"WHEN length(o) = 2 THEN 10 + {_draw('seed', 'i', 90)} ELSE 100 + {_draw('seed', 'i', 156)} END"
    )
    ip = f"array_join(transform(split(canonical, '[.]'), (o, i) -> CAST({octet} AS string)), '.')"
    digits = f"concat(left(canonical, 1), {_shape('substr(canonical, 2)', 'seed')})"
    body = f"concat(left(canonical, 1), {_shape('substr(canonical, 2, length(canonical) - 2)', 'seed')})"
    card = f"filter(transform(sequence(0, 9), d -> concat({body}, d)), x -> luhn_check(x))[0]"
    names = "CASE "
    for script, there in (("cyrillic", "canonical RLIKE '\\\\p{IsCyrillic}'"), ("latin", "true")):
        for gender in "mfn":
            given = f"transform(sequence(0, attempt), k -> {_pick(GIVEN[gender, script], 'seed', 'k')})"
            names += f"WHEN type = 'given_{gender}' AND {there} THEN array_join({given}, '-') "
        first, middle, last = SURNAME[script]
        between = f"array_join(transform(sequence(0, attempt), k -> {_pick(middle, 'seed', 'k')}), '')"
        names += (
            f"WHEN type = 'surname' AND {there} THEN "
            f"concat({_pick(first, 'seed', '-1')}, {between}, {_pick(last, 'seed', '-2')}) "
        )
    return (
        f"CASE type WHEN 'email' THEN {email} WHEN 'ip' THEN {ip} WHEN 'card' THEN {card} "
        f"WHEN 'phone' THEN {digits} WHEN 'ssn' THEN {digits} ELSE {names} END END"
    )


#: The surrogate of a canonical form, put into the format of the `value` found.
_FORMATTED = (
    "CASE WHEN surrogate IS NULL THEN value WHEN type IN ('phone', 'card', 'ssn') THEN array_join(transform("
    "sequence(1, length(value)), i -> IF(substr(value, i, 1) RLIKE '[0-9]', substr(surrogate, "
    "length(regexp_replace(substr(value, 1, i), '[^0-9]', '')), 1), substr(value, i, 1))), '') "
    "WHEN type = 'email' AND value = upper(value) THEN upper(surrogate) ELSE surrogate END"
)


def _with_matches(documents: DataFrame) -> DataFrame:
    """Rows with an entity, or digits like one: `found` has the matches in order."""
    found = f"IF(text RLIKE {_sql(HINT)}, regexp_extract_all(text, {_sql(ENTITY)}, 0), array())"
    name = common.fresh(documents, "found")
    return documents.withColumn(name, F.expr(found)).where(f"size({name}) > 0")


def occurrences(documents: DataFrame) -> DataFrame:
    """digest (of the text), nr, part, type, value, canonical: a row for each part of each match of the texts."""
    return (
        _with_matches(documents.select("text"))
        .selectExpr("md5(text) AS digest", "posexplode(found) AS (nr, m)")
        .withColumn("kind", F.expr(_kind("m")))
        .selectExpr("digest", "nr", f"posexplode({_parts()}) AS (part, p)")
        .selectExpr("digest", "nr", "part", "p.type AS type", "p.value AS value")
        .withColumn("canonical", F.expr(CANONICAL))
    )


def surrogates(found: DataFrame, key: str = KEY) -> DataFrame:
    """type, canonical, surrogate: distinct within a type, and no entity of that type. A written table."""
    entities = materialize(found.where("type IS NOT NULL").select("type", "canonical").distinct(), "entities")
    originals = entities.selectExpr("type", "canonical AS surrogate", "true AS original")
    settled, waiting, attempt = None, entities, 0
    while True:
        seed = f"sha2(concat_ws('|', {_sql(key)}, type, canonical, '{attempt}'), 256) AS seed"
        drawn = (
            waiting.selectExpr("type", "canonical", f"{attempt} AS attempt", seed)
            .withColumn("surrogate", F.expr(_propose(key)))
            .select("type", "canonical", "surrogate")
            .join(originals, ["type", "surrogate"], "left")
        )
        if settled is not None:
            taken = settled.selectExpr("type", "surrogate", "true AS taken")
            drawn = drawn.join(taken, ["type", "surrogate"], "left")
        else:
            drawn = drawn.withColumn("taken", F.lit(None).cast("boolean"))
        first = "row_number() OVER (PARTITION BY type, surrogate ORDER BY canonical) = 1"
        drawn = drawn.withColumn("fine", F.expr(f"{first} AND original IS NULL AND taken IS NULL"))
        drawn = materialize(drawn.select("type", "canonical", "surrogate", "fine"), "drawn")
        good = drawn.where("fine").drop("fine")
        settled = good if settled is None else settled.unionByName(good)
        waiting = drawn.where("NOT fine").select("type", "canonical")
        if waiting.isEmpty():
            return settled
        attempt += 1


def replace(documents: DataFrame, key: str = KEY) -> DataFrame:
    """`documents` with the entities of `text` replaced by their surrogates."""
    found = occurrences(documents).distinct()  # copies of a text count once
    named = found.join(surrogates(found, key), ["type", "canonical"], "left").withColumn("put", F.expr(_FORMATTED))
    per_text = (
        named.groupBy("digest", "nr")
        .agg(F.expr("array_join(array_sort(collect_set(struct(part, put))).put, '') AS put"))
        .groupBy("digest")
        .agg(F.expr("array_sort(collect_list(struct(nr, put))).put AS puts"))
    )
    digest, puts = common.fresh(documents, "digest"), common.fresh(documents, "puts")
    hits = _with_matches(documents).withColumn(digest, F.expr("md5(text)"))
    hits = hits.join(per_text.selectExpr(f"digest AS {digest}", f"puts AS {puts}"), digest)
    between = f"split(text, {_sql(ENTITY)}, -1)"
    hits = hits.withColumn(
        "text", F.expr(f"array_join(zip_with({between}, concat({puts}, array('')), (a, b) -> concat(a, b)), '')")
    ).select(*[F.col(f"`{c}`") for c in documents.columns])
    none = f"NOT (text RLIKE {_sql(HINT)} AND size(regexp_extract_all(text, {_sql(ENTITY)}, 0)) > 0)"
    rest = documents.where(f"coalesce({none}, true)")
    return rest.unionByName(hits)
