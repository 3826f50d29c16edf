"""PII surrogates: detected entities get keyed, type-consistent replacements.

1. One pattern finds e-mail addresses, phone, card, social-security and bank
   account numbers, IP addresses, long hex secrets, and names after a title.
2. Every entity has a canonical form (case, separators and titles aside), so all
   its spellings share one surrogate: coreference holds over the whole corpus.
   Names are taken word by word: ``Mr. John Smith`` and ``Mr Smith`` agree, and
   a name that a title reveals is replaced wherever it recurs in the same text.
3. The surrogate comes from a keyed hash of kind and canonical form: digits for
   digits, letters for letters, same length; the country code of a phone number,
   the issuer digit and checksum of a card, the width of an IP's parts and the
   top-level domain stay; names come from lists by gender and script.
4. Collision checks over the corpus: a surrogate that another entity of the kind
   has, or that is itself an original value, is drawn again (next attempt) until
   none is left; after ``WIDEN`` attempts the value gets longer, so a used-up
   format ends too. Distinct entities keep distinct surrogates.
5. Surrogates take on each mention's own separators and case.

Native DataFrame functions only. Texts move through a shuffle only if they hold
a mention. Defined cases: null stays null; texts without mention are unchanged;
equal texts share their replacements; an empty table gives an empty result;
``replace`` keeps all other columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetrank.llm import tables

WIDEN = 8

# Titles before names, with the gender they tell.
TITLES = {
    "f": "Mrs Ms Miss Mme Mlle Madame Frau Sra Señora Signora Lady г-жа Госпожа κυρία".split(),
    "m": "Mr Mister Monsieur Herr Señor Signor Sir г-н Господин κύριος".split(),
    "n": "Dr Prof Professor Mx".split(),
}
# Given and family names by script, given names by gender.
GIVEN = {
    "latin_f": "Anna Clara Diana Elena Greta Helen Irene Julia Laura Maria Nadia Olivia Paula Rosa Sarah Teresa Ursula Vera Wilma Zoe".split(),
    "latin_m": "Adam Boris Carl David Emil Felix Georg Henry Isaac Jonas Karl Leon Martin Nils Oscar Peter Robert Simon Thomas Victor".split(),
    "latin_n": "Alex Ariel Casey Dana Eden Finley Gale Harper Indigo Jamie Kim Lee Morgan Noel Parker Quinn Robin Sasha Taylor Val".split(),
    "cyrillic_f": "Анна Вера Дарья Елена Зоя Ирина Мария Нина Ольга Софья".split(),
    "cyrillic_m": "Антон Борис Виктор Глеб Денис Егор Иван Максим Олег Пётр".split(),
    "cyrillic_n": "Саша Женя Валя Слава Шура".split(),
    "greek_f": "Άννα Ελένη Ειρήνη Ζωή Μαρία Νίκη Σοφία".split(),
    "greek_m": "Αλέξης Γιώργος Δημήτρης Κώστας Νίκος Πέτρος".split(),
    "greek_n": "Φώτη Στάθη Χάρη".split(),
}
FAMILY = {
    "latin": (
        "Abbott Barlow Castell Dorsey Ellwood Farrow Garland Hadley Ingram Jessop Keller Lambert Mercer Norwood Osborne Prescott Quimby Radley"
        " Sutton Thorne Upton Vance Whitlock Yardley Zeller Ashby Bexley Corwin Denholm Everett"
    ).split(),
    "cyrillic": "Белов Волков Гусев Зимин Климов Лебедев Мельник Носков Орлов Сидоренко".split(),
    "greek": "Αγγέλου Βασιλείου Δήμου Ιωάννου Λάμπρου Μάρκου Παππά Σταύρου".split(),
}

_TITLED = {t: gender for gender, titles in TITLES.items() for title in titles for t in (title, title.upper())}
_TITLE = "|".join(_TITLED)
EMAIL = r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@[A-Za-z0-9](?:[A-Za-z0-9-]*+(?:\.(?=[A-Za-z0-9]))?+)*+(?<=\.[A-Za-z]{2,24})"
SECRET = r"(?<![A-Za-z0-9])[0-9a-fA-F]{32,}+(?![A-Za-z0-9])"
CARD = r"(?<![0-9])(?:[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[47][0-9]{2}([ -]?)[0-9]{6}\2[0-9]{5})(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
PHONE = r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
_INITIALS = "".join(sorted({t[0] for t in _TITLED}))
NAME = rf"(?=[{_INITIALS}])(?<![\p{{L}}])(?:{_TITLE})\.? \p{{Lu}}[\p{{Ll}}\p{{Lu}}]+(?:[ ]\p{{Lu}}[\p{{Ll}}\p{{Lu}}]+){{0,2}}"
# a look at the next character spares most places the alternatives that can't begin there
PATTERN = "|".join((EMAIL, f"(?=[0-9a-fA-F]){SECRET}", f"(?=[0-9+(])(?:{CARD}|{SSN}|{PHONE}|{IP})", f"(?=[A-Z]){IBAN}", NAME))
#: Every mention holds one of these; most texts do not.
TRIGGER = rf"[0-9@]|[a-fA-F]{{32}}|(?=[{_INITIALS}])(?:{_TITLE})\.? \p{{Lu}}"


def _text(column: Column) -> Column:
    return column.cast("string")


def _kind(mention: Column) -> Column:
    digits = F.length(F.regexp_replace(mention, "[^0-9]", ""))
    return (
        F.when(mention.contains("@"), "email")
        .when(mention.rlike(r"^[0-9a-fA-F]{32,}$"), "secret")
        .when(mention.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"), "ip")
        .when(mention.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(mention.rlike(r"^[0-9][0-9 -]*$") & (digits >= 15), "card")
        .when(mention.rlike(r"^[A-Z]{2}[0-9]{2}"), "iban")
        .when(mention.rlike(r"^[+(0-9]"), "phone")
        .otherwise("name")
    )


def _canonical(kind: Column, mention: Column) -> Column:
    return (
        F.when(kind.isin("email", "secret"), F.lower(mention))
        .when(kind == "ip", mention)
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .otherwise(F.regexp_replace(mention, "[^0-9+]", ""))
    )


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _is_titled(token: Column) -> Column:
    return F.regexp_replace(F.element_at(token, 1), r"\.", "").isin(*_TITLED)


def _parts(mention: Column, names: Column | None = None) -> Column:
    """A mention's parts: array of (kind, canon, surface). A name has a title
    (kind ``plain``), given names and a family name; anything else has one part.
    A bare name takes its kind from ``names``, the parts known in the text."""
    kind = _kind(mention)
    token = F.split(mention, " ")
    title = F.regexp_replace(F.element_at(token, 1), r"\.", "")
    of = lambda gender: [t for t, g in _TITLED.items() if g == gender]
    gender = F.when(title.isin(*of("f")), "f").when(title.isin(*of("m")), "m").otherwise("n")

    def of_name(word: Column, at: Column) -> Column:
        last = at == F.size(token) - 1
        named = F.when(last, F.concat(F.lit("family_"), _script(word))).otherwise(F.concat(F.lit("given_"), _script(word), F.lit("_"), gender))
        return F.struct(F.when(at == 0, "plain").otherwise(named).alias("kind"), F.lower(word).alias("canon"), word.alias("surface"))

    if names is not None:
        known = F.get(F.filter(names, lambda x: x["canon"] == F.lower(mention)), F.lit(0))["kind"]
        kind = F.when((kind == "name") & ~_is_titled(token), F.coalesce(known, F.lit("plain"))).otherwise(kind)
    canon = F.when(kind.contains("_") | (kind == "plain"), F.lower(mention)).otherwise(_canonical(kind, mention))
    one = F.array(F.struct(kind.alias("kind"), canon.alias("canon"), mention.alias("surface")))
    return F.when(kind == "name", F.transform(token, of_name)).otherwise(one)


def _draw(key: str, attempt: int) -> Column:
    """128 hex digits of a keyed hash of kind, canonical form and attempt."""
    half = lambda k: F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(str(attempt)), F.lit(str(k)), "kind", "canon"), 256)
    return F.concat(half(0), half(1))


def _number(at: Column) -> Column:
    """The at-th drawn number, 0 to 65535 (column ``draw``); numbers repeat after 32."""
    return F.conv(F.substr(F.col("draw"), F.pmod(at, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _alike(text: Column, shift: int = 0) -> Column:
    """A character of the same class for every character."""
    accented = "àáâäçèéêëìíîïñòóôöùúûü"

    def swap(c: Column, i: Column) -> Column:
        n = _number(i + shift)
        pick = lambda letters: F.substr(F.lit(letters), F.pmod(n, F.lit(len(letters))) + 1, F.lit(1))
        return (
            F.when(c.rlike("[0-9]"), pick("0123456789"))
            .when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"\p{IsCyrillic}"), pick("абвгдежзиклмнопрстуфхцчшэюя"))
            .when(c.rlike(r"\p{IsGreek}"), pick("αβγδεζηθικλμνξοπρστυφχψω"))
            .when(c.rlike(r"\p{L}"), pick(accented))
            .otherwise(c)
        )

    return F.array_join(F.transform(_chars(text), swap), "")


def _luhn(digits: Column) -> Column:
    """Checksum of a card number; 0 (mod 10) for a valid one."""
    size = F.length(digits)
    value = lambda c, i: F.when(F.pmod(size - i, F.lit(2)) == 1, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)
    )
    return F.pmod(F.aggregate(F.transform(_chars(digits), value), F.lit(0), lambda a, x: a + x), F.lit(10))


def _named(lists: dict[str, list[str]], prefix: str, attempt: int) -> Column:
    """A name from the list of the kind; later attempts join more names."""
    out = F.lit(None).cast("string")
    for name, names in lists.items():
        pool = F.array(*(F.lit(n) for n in names))
        pick = lambda k: F.element_at(pool, F.pmod(_number(F.lit(k)), F.lit(len(names))) + 1)  # noqa: E731, B023
        made = F.concat_ws("-", *(pick(k) for k in range(1 + min(attempt, WIDEN))))
        out = F.when(F.col("kind") == prefix + name, made).otherwise(out)
    return out


def _surrogate(attempt: int) -> Column:
    """The attempt's replacement for columns kind, canon, draw, in canonical form."""
    kind, canon = F.col("kind"), F.col("canon")
    at = F.instr(canon, "@")
    domain = F.substr(canon, at + 1)
    stays = F.regexp_extract(domain, r"((?:\.?example)?\.[a-z]+)$", 1)
    email = F.concat(_alike(F.substr(canon, F.lit(1), at - 1)), F.lit("@"), _alike(F.substr(domain, F.lit(1), F.length(domain) - F.length(stays)), 16), stays)
    # + and the country code stay
    code = F.regexp_extract(canon, r"^(\+?(?:(?<=\+)(?:1|7|[0-9]{2}))?)", 1)
    phone = F.concat(code, _alike(F.substr(canon, F.length(code) + 1)))
    card = F.concat(F.substr(canon, F.lit(1), F.lit(1)), _alike(F.substr(canon, F.lit(2))))
    base = F.concat(F.substr(card, F.lit(1), F.length(card) - 1), F.lit("0"))
    checked = F.concat(F.substr(card, F.lit(1), F.length(card) - 1), F.pmod(-_luhn(base), F.lit(10)).cast("string"))
    card = F.when(_luhn(canon) == 0, checked).otherwise(card)
    octet = lambda o, i: (
        F.when(F.length(o) == 3, F.pmod(_number(i), F.lit(156)) + 100).when(F.length(o) == 2, F.pmod(_number(i), F.lit(90)) + 10).otherwise(F.pmod(_number(i), F.lit(10)))
    ).cast("string")
    ip = F.array_join(F.transform(F.split(canon, r"\."), octet), ".")
    secret = F.array_join(F.transform(_chars(canon), lambda c, i: F.substr(F.col("draw"), F.pmod(i, F.lit(128)) + 1, F.lit(1))), "")
    iban = F.concat(F.substr(canon, F.lit(1), F.lit(2)), _alike(F.substr(canon, F.lit(3))))
    made = (
        F.when(kind == "email", email)
        .when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "ip", ip)
        .when(kind == "secret", secret)
        .when(kind == "iban", iban)
        .when(kind == "ssn", _alike(canon))
        .when(kind.startswith("given_"), _named(GIVEN, "given_", attempt))
        .otherwise(_named(FAMILY, "family_", attempt))
    )
    if attempt >= WIDEN:
        longer = F.substr(F.regexp_replace("draw", "[^0-9]", ""), F.lit(1), F.lit(attempt - WIDEN + 1))
        made = F.when(kind == "email", F.concat(longer, made)).otherwise(F.concat(made, longer))
    return made


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon, surrogate for distinct entities (kind, canon), without collisions:
    no two entities of a kind share a surrogate and none equals an original of its kind."""
    entities = tables.stored(entities.select("kind", "canon").distinct(), "entities")
    left, done, attempt = entities, None, 0
    while True:
        drawn = left.withColumn("draw", _draw(key, attempt)).withColumn("surrogate", _surrogate(attempt))
        taken = entities.select("kind", F.col("canon").alias("folded"))
        if done is not None:
            taken = taken.union(done.select("kind", F.lower("surrogate")))
        drawn = drawn.withColumn("folded", F.when(F.col("kind") == "iban", F.col("surrogate")).otherwise(F.lower("surrogate")))
        free = drawn.join(taken.distinct(), ["kind", "folded"], "left_anti")
        # of several that drew the same, one keeps it
        kept = free.groupBy("kind", "folded").agg(F.min_by(F.struct("canon", "surrogate"), F.xxhash64(F.lit(key), "canon")).alias("k"))
        kept = tables.stored(kept.select("kind", "k.canon", "k.surrogate"), "kept")
        done = kept if done is None else tables.stored(done.union(kept), "surrogates")
        left = tables.stored(left.join(kept, ["kind", "canon"], "left_anti").select("kind", "canon"), "left")
        if left.isEmpty():
            return done
        attempt += 1


def _rendered(kind: Column, surface: Column, surrogate: Column) -> Column:
    """The surrogate with the mention's separators and case."""

    def dealt(chars: str) -> Column:
        between = F.split(surface, chars)
        kept = F.regexp_replace(surrogate, "[^0-9A-Za-z]", "")
        return F.array_join(F.zip_with(between, _chars(kept), lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))), "")

    shouted = (surface == F.upper(surface)) & (surface != F.lower(surface))
    cased = F.when(shouted, F.upper(surrogate)).otherwise(surrogate)
    return (
        F.when(surrogate.isNull(), surface)
        .when(kind.isin("phone", "card", "ssn"), dealt("[0-9]"))
        .when(kind == "iban", dealt("[0-9A-Za-z]"))
        .when(kind == "ip", surrogate)
        .otherwise(cased)
    )


def _private(text: Column) -> Column:
    return F.coalesce(text.rlike(TRIGGER) & text.rlike(PATTERN), F.lit(False))


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text), F.xxhash64(F.lit("second"), text)]


def mentions(docs: DataFrame) -> DataFrame:
    """h1, h2 (of the text), pattern, m, p (place of mention and part), kind, canon,
    surface; equal texts once. ``pattern`` finds the text's mentions: PATTERN and
    the names that titles reveal in it."""
    text = _text(F.col("text"))
    h1, h2 = _text_key(text)
    found = docs.where(_private(text)).select(h1.alias("h1"), h2.alias("h2"), text.alias("text"))
    all_of = lambda pattern: F.regexp_extract_all("text", pattern, F.lit(0))
    found = found.withColumn("found", all_of(F.lit(PATTERN)))
    named = F.filter("found", lambda m: _kind(m) == "name")
    known = F.filter(F.flatten(F.transform(named, lambda m: _parts(m))), lambda x: x["kind"] != "plain")
    found = found.withColumn("names", F.array_distinct(known))
    bare = F.array_join(F.array_distinct(F.transform("names", lambda x: x["surface"])), "|")
    pattern = F.concat(F.lit(PATTERN + r"|(?<!\p{L})(?:"), bare, F.lit(r")(?!\p{L})"))
    found = found.withColumn("pattern", F.when(F.size("names") > 0, pattern))
    found = found.withColumn("found", F.when(F.size("names") > 0, all_of(F.col("pattern"))).otherwise(F.col("found")))
    found = found.groupBy("h1", "h2").agg(*(F.first(c).alias(c) for c in ("pattern", "names", "found")))
    each = found.select("h1", "h2", "pattern", "names", F.posexplode("found").alias("m", "mention"))
    part = each.select("h1", "h2", "pattern", "m", F.posexplode(_parts(F.col("mention"), F.col("names"))).alias("p", "part"))
    return part.select("h1", "h2", "pattern", "m", "p", "part.*")


def replace(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text``; all columns kept, in order."""
    parts = tables.stored(mentions(docs), "mentions")
    known = surrogates(parts.where("kind <> 'plain'").select("kind", "canon"), key)
    rendered = parts.join(tables.small_side(known, known.count(), 160), ["kind", "canon"], "left")
    rendered = rendered.select("h1", "h2", "pattern", "m", "p", _rendered(F.col("kind"), F.col("surface"), F.col("surrogate")).alias("new"))
    by_mention = rendered.groupBy("h1", "h2", "pattern", "m").agg(F.array_sort(F.collect_list(F.struct("p", "new"))).alias("parts"))
    by_mention = by_mention.select("h1", "h2", "pattern", "m", F.array_join(F.transform("parts", lambda x: x["new"]), " ").alias("new"))
    by_text = by_mention.groupBy("h1", "h2").agg(F.first("pattern").alias("pattern"), F.array_sort(F.collect_list(F.struct("m", "new"))).alias("news"))
    by_text = by_text.select("h1", "h2", F.coalesce("pattern", F.lit(PATTERN)).alias("pattern"), F.transform("news", lambda x: x["new"]).alias("news"))

    columns = docs.columns
    fresh = lambda base: next(n for n in (base + "_" * k for k in range(len(columns) + 1)) if n not in columns)
    one, two, pattern, news = (fresh(f"pii_{c}") for c in ("h1", "h2", "pattern", "new"))
    by_text = by_text.toDF(one, two, pattern, news)
    text = _text(docs["text"])
    h1, h2 = _text_key(text)
    private = _private(text)
    touched = docs.where(private).join(by_text, (h1 == by_text[one]) & (h2 == by_text[two]))
    between = F.split(text, by_text[pattern], -1)
    changed = F.array_join(F.zip_with(between, by_text[news], lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))), "")
    touched = touched.select(*(changed.alias("text") if c == "text" else docs[c] for c in columns))
    return docs.where(~private).select(*(text.alias("text") if c == "text" else docs[c] for c in columns)).union(touched)
