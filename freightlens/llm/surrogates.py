"""Personal data replaced by keyed surrogates of the same type, on DataFrame functions only.

Entities are found by patterns: mail addresses, access keys, values of passwords and tokens, account
and card numbers, network addresses, telephone and social security numbers, and names after a title. An
entity's canonical form (digits of a number, lower case of a name or address) is what it refers to: equal
canonical forms get equal surrogates in all documents. A surrogate is drawn from SHA-256 of a key, the
type, the canonical form and an attempt. It keeps the format: separators, letter case, digits for digits
and letters for letters, a valid checksum where there was one, the first digit of a card, the
country code of a telephone number, the top-level domain. Names are built from syllables of their
script; given names end as their title's gender asks, the last name after a title is a family name.
A given name used with titles of both genders has a surrogate for each; without a gender it takes the one it has elsewhere.
Words of a text that repeat a part of a name titled in the same text are replaced alike, wherever they stand; such
mentions are not counted as entities.
All distinct entities are checked together: of those that share a surrogate one keeps it, and a
surrogate must not be an entity of the corpus; the others try again, from the third attempt
on with longer forms, until none is left.

Defined results: null and empty texts have no entities and stay as they are; repeated rows get equal
results; an empty table gives an empty result; a column named n_entities of the
input stays, and the count is then named n_entities_found.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import stage

# Titles by gender.
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин", "г-н", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mademoiselle", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Doña", "госпожа", "г-жа", "κυρία"],
    "n": ["Dr", "Prof", "Professor", "Doctor"],
}
#: Accents may be written as marks of their own.
TITLES = {g: list(dict.fromkeys([*ts, *(unicodedata.normalize("NFD", t) for t in ts)])) for g, ts in TITLES.items()}
#: Letters with their marks, and digits, of any script.
LETTER = r"\p{L}\p{M}"
WORD = rf"{LETTER}\p{{N}}"
#: Scripts written without spaces between words, and Hangul, which joins endings to foreign words.
SPACELESS = r"\u0E00-\u0EFF\u1000-\u109F\u1100-\u11FF\u1780-\u17FF\u3005-\u3007\u3040-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uAC00-\uD7AF\uF900-\uFAFF\uFF66-\uFF9F\x{20000}-\x{3FFFF}"
#: Apostrophes belong to a name, but not the one of a possessive or a closing quote.
PART = rf"\p{{Lu}}(?:[{LETTER}\-&&[^{SPACELESS}]]|['’](?!s?(?![{LETTER}])))++(?!\p{{N}})"
EVERY_TITLE = "|".join(t for group in TITLES.values() for t in sorted(group, key=len, reverse=True))
SECRETS = "password|passwd|pwd|token|secret|api_key|apikey"

#: What stands before the part of a match that is replaced: a title, or the name of a secret.
LEAD = rf"(?:{EVERY_TITLE})\.? |(?i:{SECRETS})[\"']?\s{{0,2}}[=:]\s{{0,2}}[\"']?"

# Patterns in order of precedence.
PATTERNS = {
    "email": rf"[{WORD}._%+-]++@[{WORD}-]+(?:\.[{WORD}-]+)*\.(?:[{LETTER}&&[^{SPACELESS}]]{{2,}}|[{LETTER}]{{2,}})",
    "key": r"A[KS]IA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "secret": rf"(?i:{SECRETS})[\"']?\s{{0,2}}[=:]\s{{0,2}}[\"']?[A-Za-z0-9+/_.-]{{8,}}",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<!\.)(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)",
    "phone": r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\d)|\(\d{3}\) ?\d{3}-\d{4}(?!\d)|\d{3}-\d{3}-\d{4}(?!\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?!\d)",
    "card": r"\d(?:[ -]?\d){12,18}(?![A-Za-z0-9])",
    "name": rf"(?=[DFHMPSгκ])(?:{EVERY_TITLE})\.? {PART}(?: {PART}){{0,2}}",
}
#: Where an entity of letters starts: behind another entity, or behind no letter or digit of a script with spaces.
WORDS = rf"(?:\G|(?<![A-Za-z0-9])(?<![{WORD}&&[^{SPACELESS}]]))"
#: Where a number starts: only a digit before it makes it part of another one, and nothing does before a bracket.
NUMBERS = r"(?=[\d+(])(?:(?<!\d)|(?=\())"
STARTS = {kind: NUMBERS if kind in ("ip", "phone", "ssn", "card") else WORDS for kind in PATTERNS}
#: An address starts where its run of letters and digits does, in any script.
STARTS["email"] = rf"(?:\G|(?<![A-Za-z0-9])(?<![{WORD}]))"
#: A capitalised word, which may repeat a part of a name.
MENTION = rf"(?<![A-Za-z0-9])(?<![{WORD}&&[^{SPACELESS}]]){PART}"
EVERY = "|".join(f"(?:{STARTS[kind]}(?:{p}))" for kind, p in PATTERNS.items())
#: Texts without a match of this have no entity: every pattern needs one of these, wherever it starts.
TRIGGER = rf"[0-9@]|A[KS]IA|(?i:{SECRETS})|(?=[DFHMPSгκ])(?:{EVERY_TITLE})\.? "

# Parts of names by script.
ONSETS = {"latin": "b d f g h j k l m n p r s t v w".split(), "cyrillic": "б в г д ж з к л м н п р с т ф х".split(), "greek": "β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ ψ".split()}
VOWELS = {"latin": "a e i o u".split(), "cyrillic": "а е и о у".split(), "greek": "α ε ι ο υ".split()}
ENDINGS = {
    "latin": {"m": ["n", "r", "s", "l"], "f": ["a", "na", "ra", "la"], "n": ["n", "l", "m", "t"], "family": ["ner", "son", "man", "berg"]},
    "cyrillic": {"m": ["н", "р", "с", "л"], "f": ["на", "ра", "ла", "та"], "n": ["н", "л", "м", "т"], "family": ["нко", "вич", "рук", "лян"]},
    "greek": {"m": ["νος", "ρος", "ης", "ας"], "f": ["να", "ρα", "λη", "τη"], "n": ["ν", "λ", "μ", "τ"], "family": ["δης", "κος", "τος", "λας"]},
}


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def _kind(e: Column) -> Column:
    out = F.when(e.rlike(f"^(?:{PATTERNS['secret']})$"), "secret").when(e.contains("@"), "email").when(e.rlike(f"^(?:{PATTERNS['key']})$"), "key").when(e.rlike(f"^(?:{EVERY_TITLE})\\.? "), "name")
    for kind in ("ip", "ssn", "phone", "card", "iban"):
        out = out.when(e.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return out.otherwise("secret")


def _lead(kind: Column, e: Column) -> Column:
    return F.when(kind.isin("name", "secret"), F.regexp_extract(e, f"^({LEAD})", 1)).otherwise("")


def _stream(seed: Column, length: Column) -> Column:
    """Hex digits drawn from a seed, two per place, for `length` places."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(length / 32).cast("int")), lambda i: F.sha2(F.concat_ws("|", seed, i.cast("string")), 256))
    return F.array_join(blocks, "")


def _number(stream: Column, place: Column) -> Column:
    """The number between 0 and 255 at a place (from 1)."""
    return F.conv(F.substring(stream, place * 2 - 1, F.lit(2)), 16, 10).cast("int")


def _redrawn(form: Column, stream: Column, kept: Column) -> Column:
    """Digits for digits, letters for letters of the same case, behind the first `kept` characters."""
    def one(i: Column) -> Column:
        c, n = F.substring(form, i, F.lit(1)), _number(stream, i)
        return (
            F.when(i <= kept, c).when(c.rlike("[0-9]"), F.pmod(n, F.lit(10)).cast("string"))
            .when(c.rlike(r"\p{Lu}"), F.char(F.pmod(n, F.lit(26)) + 65)).when(c.rlike(r"\p{L}"), F.char(F.pmod(n, F.lit(26)) + 97)).otherwise(c)
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), one), "")


def _hex(form: Column, stream: Column) -> Column:
    return F.substring(stream, F.lit(1), F.length(form))


def _luhn(digits: Column) -> Column:
    """The checksum of a number whose last digit is its check digit: 0 where valid."""
    def one(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.pmod(F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), one), F.lit(0), lambda a, x: a + x), F.lit(10))


def _card(form: Column, stream: Column) -> Column:
    n = F.length(form)
    body = F.substring(_redrawn(form, stream, F.lit(1)), F.lit(1), n - 1)
    valid = F.pmod(F.lit(10) - _luhn(F.concat(body, F.lit("0"))), F.lit(10))
    off = F.when(_luhn(form) == 0, 0).otherwise(1 + F.pmod(_number(stream, n), F.lit(9)))
    return F.concat(body, F.pmod(valid + off, F.lit(10)).cast("string"))


def _address(stream: Column) -> Column:
    place = lambda i, n, a: (F.pmod(_number(stream, F.lit(i)) * 256 + _number(stream, F.lit(i + 4)), F.lit(n)) + a).cast("string")
    return F.concat_ws(".", place(1, 223, 1), place(2, 256, 0), place(3, 256, 0), place(4, 254, 1))


def _pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.pmod(n, F.lit(len(values))) + 1)


def _script(c: Column) -> Column:
    return F.when(c.rlike(r"\p{IsCyrillic}"), "cyrillic").when(c.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _name(role: Column, form: Column, stream: Column, extra: Column) -> Column:
    def of(script: str) -> Column:
        syllable = lambda i: F.concat(_pick(ONSETS[script], _number(stream, i * 2 - 1)), _pick(VOWELS[script], _number(stream, i * 2)))
        stem = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2) + extra), syllable), "")
        end = None
        for r, values in ENDINGS[script].items():
            value = _pick(values, _number(stream, F.lit(31)))
            end = F.when(role == r, value) if end is None else end.when(role == r, value)
        return F.concat(stem, end)

    script = _script(form)
    return F.when(script == "cyrillic", of("cyrillic")).when(script == "greek", of("greek")).otherwise(of("latin"))


def drawn(entities: DataFrame, key: str) -> DataFrame:
    """Adds the surrogate's canonical form to (kind, role, form, attempt).

    The hash streams are columns of their own, so that the many expressions that read them don't repeat them.
    """
    kind, role, form, attempt = (F.col(c) for c in ("kind", "role", "form", "attempt"))
    domain = F.substring(form, F.instr(form, "@") + 1, F.length(form))
    e = entities.withColumn("_extra", F.least(F.greatest(attempt - 1, F.lit(0)), F.lit(12))).withColumn(
        "_host", F.when(kind == "email", F.regexp_extract(domain, r"^(.*)\.[^.]+$", 1)).otherwise("")
    )
    e = e.withColumn("_stream", _stream(F.concat_ws("|", F.lit(key), kind, role, form, attempt.cast("string")), F.length(form) + 64))
    # The domain has a stream of its own, so that addresses of one domain stay together.
    e = e.withColumn("_shared", _stream(F.concat_ws("|", F.lit(key), F.lit("domain"), F.col("_host")), F.length("_host")))
    extra, host, stream, shared = (F.col(c) for c in ("_extra", "_host", "_stream", "_shared"))
    local = F.substring(form, F.lit(1), F.instr(form, "@") - 1)
    pad = F.substring(F.lower(F.regexp_replace(stream, "[0-9]", "")), F.lit(3), extra)
    email = F.concat(_redrawn(local, stream, F.lit(0)), pad, F.lit("@"), _redrawn(host, shared, F.lit(0)), F.substring(domain, F.length(host) + 1, F.length(domain)))
    longer = F.substring(F.regexp_replace(stream, "[a-f]", ""), F.lit(5), F.greatest(extra - 6, F.lit(0)))
    # Kept at the front: a telephone number's country code, a key's brand, an account's country.
    kept = F.when(kind == "phone", F.length(role)).when(kind == "key", 4).when(kind == "iban", 2).otherwise(0)
    other = F.when((kind == "secret") & form.rlike("^[0-9a-f]+$"), _hex(form, stream)).otherwise(_redrawn(form, stream, kept))
    new = (
        F.when(kind == "email", email).when(kind == "ip", _address(stream)).when(kind == "card", F.concat(_card(form, stream), longer))
        .when(kind.isin("phone", "ssn"), F.concat(_redrawn(form, stream, kept), longer)).when(kind == "name", _name(role, form, stream, extra))
        .otherwise(other)
    )
    return e.withColumn("surrogate", new).drop("_extra", "_host", "_stream", "_shared")


def _rendered(kind: Column, entity: Column, form: Column) -> Column:
    """A surrogate in the written format of the entity that it replaces."""
    def place(i: Column) -> Column:
        c = F.substring(entity, i, F.lit(1))
        return F.when(c.rlike(r"\d"), F.substring(form, F.length(_digits(F.substring(entity, F.lit(1), i))), F.lit(1))).otherwise(c)

    numbers = F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.length(entity)), place), ""), F.substring(form, F.length(_digits(entity)) + 1, F.length(form)))
    cased = F.when(entity == F.upper(entity), F.upper(form)).when(entity == F.lower(entity), F.lower(form)).when(kind == "name", F.initcap(form)).otherwise(form)
    spaced = F.array_join(F.transform(F.sequence(F.lit(1), F.length(entity)), lambda i: F.when(F.substring(entity, i, F.lit(1)) == " ", " ").otherwise(
        F.substring(form, F.length(F.replace(F.substring(entity, F.lit(1), i), F.lit(" "), F.lit(""))), F.lit(1)))), "")
    return F.when(kind.isin("phone", "card", "ssn"), numbers).when(kind.isin("email", "name"), cased).when(kind == "iban", spaced).otherwise(form)


def _occurrences(hits: DataFrame) -> DataFrame:
    """(row, pos, part, kind, role, entity, form): every entity, names by their parts, with its canonical form."""
    found = hits.select("row", F.posexplode("entities").alias("pos", "whole")).withColumn("kind", _kind(F.col("whole")))
    found = found.withColumn("lead", _lead(F.col("kind"), F.col("whole")))
    title = F.regexp_extract("whole", f"^({EVERY_TITLE})\\.? ", 1)
    body = F.substring(F.col("whole"), F.length("lead") + 1, F.length("whole"))
    found = found.withColumn("parts", F.when(F.col("kind") == "name", F.split(body, " ")).otherwise(F.array(body)))
    found = found.select("row", "pos", "kind", "whole", F.size("parts").alias("n"), F.posexplode("parts").alias("part", "entity"))
    gender = F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f").otherwise("n")
    code = F.when(F.col("entity").startswith("+1"), "1").otherwise(F.regexp_extract("entity", r"^\+(\d{1,3})(?=[ .(-])", 1))
    role = F.when(F.col("kind") == "name", F.when(F.col("part") == F.col("n") - 1, "family").otherwise(gender)).when(F.col("kind") == "phone", code).otherwise("")
    form = (
        F.when(F.col("kind").isin("phone", "card", "ssn"), _digits(F.col("entity"))).when(F.col("kind").isin("email", "name"), F.lower("entity"))
        .when(F.col("kind") == "iban", F.replace(F.col("entity"), F.lit(" "), F.lit(""))).otherwise(F.col("entity"))
    )
    return found.select("row", "pos", "part", "kind", role.alias("role"), "entity", form.alias("form"))


def distinct_entities(found: DataFrame) -> DataFrame:
    """(kind, form, role): each entity once, a given name once per gender. A gender wins over uses without one; a longer country code over none."""
    role = F.col("role")
    weight = F.when(role == "family", 50).otherwise(F.length("role"))
    gendered = role.isin("m", "f")
    each = found.groupBy("kind", "form").agg(F.collect_set(F.when(gendered, role)).alias("genders"), F.max_by("role", F.struct(weight, "role")).alias("plain"))
    roles = F.when(F.size("genders") > 0, F.col("genders")).otherwise(F.array("plain"))
    return each.select("kind", "form", F.explode(roles).alias("role"))


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, form, role, surrogate) for distinct (kind, form, role), without collisions."""
    taken = entities.select("kind", F.col("form").alias("surrogate")).distinct()
    table = entities.withColumn("attempt", F.lit(0))
    while True:
        table = stage(drawn(table, key), "surrogates-tried")
        first = table.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "form", "role")).alias("first"))
        real = taken.withColumn("real", F.lit(True))
        keeps = (F.col("first.form") == F.col("form")) & (F.col("first.role") == F.col("role"))
        judged = table.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left").select(
            "kind", "role", "form", "attempt", "surrogate", (F.col("real").isNotNull() | ~keeps).alias("clash")
        )
        judged = stage(judged, "surrogates-judged")
        if judged.where("clash").limit(1).count() == 0:
            return judged.select("kind", "form", "role", "surrogate")
        table = judged.select("kind", "role", "form", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"))


def _mentions(piece: Column, names: Column, news: Column) -> Column:
    """A piece of text with the capitalised words that are among names (lower case) replaced."""
    words, gaps = F.regexp_extract_all(piece, F.lit(MENTION), F.lit(0)), F.split(piece, MENTION, -1)

    def one(word: Column) -> Column:
        at = F.array_position(names, F.lower(word)).cast("int")
        new = F.element_at(news, F.greatest(at, F.lit(1)))
        return F.when(at == 0, word).when(word == F.upper(word), F.upper(new)).otherwise(new)

    tail = F.zip_with(F.transform(words, one), F.slice(gaps, 2, F.size(words)), lambda a, b: F.concat(a, b))
    return F.concat(F.element_at(gaps, 1), F.array_join(tail, ""))


def with_surrogates(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The documents with their entities replaced, and n_entities. Whoever knows the key can test guesses of the entities, so it must be secret."""
    clash = [c for c in docs.columns if c in ("n_entities", "entities", "row", "new", "pieces", "names", "news")]
    if clash:
        inner = with_surrogates(docs.withColumnsRenamed({c: f"_own_{c}" for c in clash}), key, text)
        return inner.withColumnsRenamed({"n_entities": "n_entities_found"} if "n_entities" in clash else {}).withColumnsRenamed({f"_own_{c}": c for c in clash})
    columns = [*docs.columns, "n_entities"]
    likely = F.coalesce(F.col(text).rlike(TRIGGER), F.lit(False))
    body = docs.where(likely).withColumn("entities", F.regexp_extract_all(F.col(text), F.lit(EVERY), F.lit(0)))
    # A row's number must not change between readings, so the rows that may have entities are written first.
    body = stage(body.withColumn("row", F.monotonically_increasing_id()), "surrogates-likely")
    hits = body.where(F.size("entities") > 0)
    plain = docs.where(~likely).unionByName(body.where(F.size("entities") == 0).select(*docs.columns)).withColumn("n_entities", F.lit(0).cast("long")).select(*columns)
    found = _occurrences(hits)
    table = surrogate_table(stage(distinct_entities(found), "surrogates-entities"), key)
    of = lambda role: F.max(F.when(F.col("role") == role, F.col("surrogate")))
    per_form = table.groupBy("kind", "form").agg(of("m").alias("_m"), of("f").alias("_f"), F.max_by("surrogate", "role").alias("_any"))
    chosen = F.when(F.col("role") == "m", F.col("_m")).when(F.col("role") == "f", F.col("_f")).otherwise(F.col("_any"))
    written = found.join(per_form, ["kind", "form"]).select("row", "pos", "part", "kind", _rendered(F.col("kind"), F.col("entity"), chosen).alias("new"), "entity")
    by_row = written.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "part", "kind", "new", "entity"))).alias("new"))
    joined = hits.join(by_row, "row")
    named = F.filter("new", lambda x: x["kind"] == "name")
    joined = joined.withColumns({"pieces": F.split(F.col(text), EVERY, -1), "names": F.transform(named, lambda x: F.lower(x["entity"])), "news": F.transform(named, lambda x: x["new"])})
    mended = F.transform("pieces", lambda p: _mentions(p, F.col("names"), F.col("news")))
    joined = joined.withColumn("pieces", F.when(F.size("names") > 0, mended).otherwise(F.col("pieces")))
    pieces = F.col("pieces")

    def entity(e: Column, i: Column) -> Column:
        own = F.filter(F.col("new"), lambda x: x["pos"] == i)
        return F.concat(_lead(F.element_at(own, 1)["kind"], e), F.array_join(F.transform(own, lambda x: x["new"]), " "))

    replaced = F.concat(F.element_at(pieces, 1), F.array_join(F.zip_with(F.transform("entities", entity), F.slice(pieces, 2, F.size("entities")), lambda a, b: F.concat(a, b)), ""))
    cut = joined.withColumn(text, replaced).withColumn("n_entities", F.size("entities").cast("long")).select(*columns)
    return plain.unionByName(cut)
