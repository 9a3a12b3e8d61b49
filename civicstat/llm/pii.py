"""Surrogates for personal data and secrets, in Spark expressions only.

Each entity gets a replacement of its own kind, made from a keyed hash of its canonical form, so the
same entity gets the same surrogate in all documents and forms (coreference), and who has no
key can't go back. Replacements keep gender and script of names, script of letters and digits, and the
format: separators, upper case, prefixes, a card's brand and whether its check digit holds.

Two entities never share a surrogate (distinctness), and no surrogate is an entity of the corpus:
the distinct entities are checked for collisions by a grouped count and an anti join, and those
that collide draw again with the next attempt number until none is left. Names of a script are
checked together, given and family names of every gender. A person's gender is settled over all
mentions of the full name, so a title that tells less leads to the same name. After ``ATTEMPTS`` draws
surrogates get longer by a place a draw (addresses leave their private network), so that there
are always free ones.

Only mentions are shuffled for this. Texts without a digit, ``@``, ``=`` or name pass by untouched; the
others meet their replacements in one join by row.

Defined results:

- a phone has 7 digits or more, a secret a letter or digit; letters and digits of scripts without
  an alphabet below become Latin letters and digits 0-9;
- null text stays null, empty text stays empty;
- null ids and repeated rows are fine: rows are joined by id and a digest of the text, which
  determine the result;
- an empty table gives an empty result;
- all columns of the input are kept, whatever their names; only ``text_col`` changes.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstat.llm.common import stage

#: Draws in an entity's own length; then each draw is one place longer than the one before.
ATTEMPTS = 40

# Titles by gender, given names by script and gender, syllables by script.
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Госпожа"],
    "n": ["Mx", "Dr", "Prof", "Professor", "Doctor"],
}
GIVEN = {
    ("latin", "m"): ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Paul", "Hans", "Pierre", "Jean", "Carlos", "José", "Juan", "Luis"],
    ("latin", "f"): ["Mary", "Anna", "Susan", "Linda", "Sarah", "Karen", "Laura", "Emma", "Julia", "Maria", "Marie", "Claire", "Sophie", "Carmen", "Lucía", "Ingrid"],
    ("cyrillic", "m"): ["Иван", "Пётр", "Сергей", "Андрей", "Николай", "Дмитрий"],
    ("cyrillic", "f"): ["Анна", "Мария", "Ольга", "Елена", "Наталья", "Татьяна"],
    ("greek", "m"): ["Γιώργος", "Νίκος", "Κώστας", "Δημήτρης"],
    ("greek", "f"): ["Μαρία", "Ελένη", "Κατερίνα", "Σοφία"],
}
SYLLABLES = {
    "latin": ["ba", "den", "fel", "gor", "hal", "jin", "kes", "lor", "mar", "nev", "pol", "ran", "sil", "tam", "ver", "wen"],
    "cyrillic": ["ба", "ден", "фел", "гор", "хал", "жин", "кес", "лор", "мар", "нев", "пол", "ран", "сил", "там", "вер", "зен"],
    "greek": ["βα", "δεν", "φελ", "γορ", "χαλ", "ζιν", "κεσ", "λορ", "μαρ", "νεβ", "πολ", "ραν", "σιλ", "ταμ", "περ", "θεν"],
}
ENDINGS = {
    ("latin", "m"): "o", ("latin", "f"): "a", ("latin", "n"): "i",
    ("cyrillic", "m"): "ов", ("cyrillic", "f"): "а", ("cyrillic", "n"): "и",
    ("greek", "m"): "ος", ("greek", "f"): "α", ("greek", "n"): "ι",
}
#: Characters that stand for each other.
ALPHABETS = [
    "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    "àáâãäåçèéêëìíîïñòóôõöùúûüý", "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ",
    "٠١٢٣٤٥٦٧٨٩", "۰۱۲۳۴۵۶۷۸۹", "०१२३४५६७८९", "０１２３４５６７８９",
]

_B, _E = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
#: A further digit of a phone; spelled out, since look-behinds take no repeated groups.
_MORE = r"[ .\-()]{0,3}\p{Nd}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_NAME = r"\p{Lu}[\p{L}'’\-]+"
_TITLE = "|".join(t for g in TITLES.values() for t in sorted(g, key=len, reverse=True))
_GIVEN = "|".join(n for g in GIVEN.values() for n in g)
#: Kinds in order of precedence; each pattern matches a whole mention and has no capturing group.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)+",
    "key": rf"{_B}AKIA[A-Z0-9]{{16}}{_E}",
    "secret": r"(?i:(?:password|passwd|pwd|token|secret|api_key)\s{0,2}[=:]\s{0,2})[\"']?(?=[+/_\-]*+[A-Za-z0-9])[A-Za-z0-9+/_\-]{8,}+[\"']?",
    "ip": rf"{_B}(?<![0-9]\.){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9]){_E}",
    "iban": rf"{_B}[A-Z]{{2}}[0-9]{{2}}(?: ?[0-9A-Z]{{4}}){{3,7}}(?: ?[0-9A-Z]{{1,3}})?{_E}",
    "ssn": rf"{_B}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_E}",
    "phone": rf"(?:\+\p{{Nd}}{{1,3}}(?:[ .\-]?\(?\p{{Nd}}{{1,4}}\)?){{2,5}}(?<=\p{{Nd}}{_MORE * 6}\)?)|(?:\(\p{{Nd}}{{3}}\) ?|{_B}\p{{Nd}}{{3}}[ .\-])\p{{Nd}}{{3}}[ .\-]\p{{Nd}}{{4}}){_E}",
    "card": rf"{_B}[0-9](?:[ \-]?[0-9]){{12,18}}{_E}",
    "person": rf"(?<!\p{{L}})(?=\p{{Lu}})(?:(?:{_TITLE})\.? {_NAME}(?: {_NAME}){{0,2}}|(?:{_GIVEN})(?: {_NAME}){{1,2}})",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: Texts without a match of this have no entity.
MAYBE = rf"[\p{{Nd}}@=]|(?i:password|passwd|pwd|token|secret|api_key)\s{{0,2}}:|(?<!\p{{L}})(?=\p{{Lu}})(?:{_TITLE}|{_GIVEN})\.? \p{{Lu}}"
_DIGITS = "".join(a for a in ALPHABETS if len(a) == 10)


def _kind(raw: Column) -> Column:
    # lookarounds of a mention's neighbours hold at the ends of the mention too
    return reduce(lambda rest, k: F.when(raw.rlike(f"^(?:{KINDS[k]})$"), k).otherwise(rest), reversed(KINDS), F.lit(None).cast("string"))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _gender(words: Column) -> Column:
    """By the title, else by the given name."""
    first = F.regexp_replace(F.element_at(words, 1), r"\.$", "")
    names = {g: [n for (s, h), ns in GIVEN.items() if h == g for n in ns] for g in "mf"}
    has = lambda ns: F.exists(words, lambda w: w.isin(ns))
    return (F.when(first.isin(TITLES["m"]), "m").when(first.isin(TITLES["f"]), "f")
            .when(has(names["m"]), "m").when(has(names["f"]), "f").otherwise("n"))


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, r"[^\p{Nd}]", "")


def _pieces(raw: Column, kind: Column) -> Column:
    """Parts (kind, canon, form) of a mention in order; a part without a kind is kept as it stands."""
    part = lambda k, canon, form: F.struct(k.alias("kind"), canon.alias("canon"), form.alias("form"))
    keep = lambda form: part(F.lit(None).cast("string"), F.lit(None).cast("string"), form)
    own = lambda k, canon, form=raw: part(F.lit(k), canon, form)
    digits = _digits(raw)
    national = F.when(digits.rlike(r"^1[0-9]{10}$"), F.substring(digits, 2, 10)).otherwise(digits)
    secret = F.regexp_extract(raw, r"^(.*?[=:]\s*[\"']?)(.*?)([\"']?)$", 2)
    words = F.split(raw, " ", -1)
    titles = [t for g in TITLES.values() for t in g]
    gender, last = _gender(words), F.size(words)
    named = F.transform(words, lambda w, i: F.when(
        (i == 0) & F.regexp_replace(w, r"\.$", "").isin(titles), keep(w)).otherwise(part(
            F.concat(F.when((i + 1 == last) & (last > 1), "family").otherwise(F.concat(F.lit("given:"), gender)), F.lit(":"), _script(w)), F.lower(w), w)))
    spaced = F.transform(named, lambda p, i: F.struct(p["kind"].alias("kind"), p["canon"].alias("canon"), p["form"].alias("form"), (i > 0).alias("spaced")))
    plain = lambda *ps: F.transform(F.array(*ps), lambda p: F.struct(p["kind"].alias("kind"), p["canon"].alias("canon"), p["form"].alias("form"), F.lit(False).alias("spaced")))
    return (F.when(kind == "person", spaced)
            .when(kind == "secret", plain(keep(F.regexp_extract(raw, r"^(.*?[=:]\s*[\"']?)(.*?)([\"']?)$", 1)), own("secret", secret, secret), keep(F.regexp_extract(raw, r"^(.*?[=:]\s*[\"']?)(.*?)([\"']?)$", 3))))
            .when(kind == "email", plain(own("email", F.lower(raw))))
            .when(kind == "phone", plain(own("phone", national)))
            .when(kind == "card", plain(own("card", digits)))
            .when(kind == "ssn", plain(own("ssn", digits)))
            .when(kind == "iban", plain(own("iban", F.regexp_replace(raw, " ", ""))))
            .when(kind == "ip", plain(own("ip", raw)))
            .otherwise(plain(own("key", raw))))


def _byte(stream: Column, i: Column) -> Column:
    """Byte ``i`` of a hex string of 128 bytes."""
    return F.conv(F.substring(stream, (i % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def _same_class(text: Column, stream: Column, hex_only: Column) -> Column:
    """``text`` with each letter and digit replaced by one of its own alphabet."""
    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        out = F.when(hex_only & c.rlike("[0-9a-f]"), F.substring(F.lit("0123456789abcdef"), b % 16 + 1, F.lit(1)))
        for a in ALPHABETS:
            out = out.when(F.instr(F.lit(a), c) > 0, F.substring(F.lit(a), b % len(a) + 1, F.lit(1)))
        for group, a in ((r"\p{Nd}", ALPHABETS[0]), (r"\p{Lu}", ALPHABETS[2]), (r"\p{L}", ALPHABETS[1])):
            out = out.when(c.rlike(group), F.substring(F.lit(a), b % len(a) + 1, F.lit(1)))
        return out.otherwise(c)
    return F.array_join(F.transform(F.split(text, "", -1), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the digits of the check, the last digit's place being 0."""
    places = F.transform(F.split(F.reverse(digits), "", -1), lambda c, i: F.when(i % 2 == 0, F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0))).otherwise(_doubled(F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0)))))
    return F.aggregate(places, F.lit(0), lambda s, d: s + d)


def _doubled(d: Column) -> Column:
    return F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)


def _candidate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate in canonical form that an entity draws at an attempt."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"))
    stream = F.concat(F.sha2(seed, 512), F.sha2(F.concat(seed, F.lit("+")), 512))
    domain = F.substring_index(canon, "@", -1)
    host = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), domain), 512)
    tld = F.substring_index(domain, ".", -1)
    label = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: _pick(SYLLABLES["latin"], _byte(host, i))), "")
    hex_only = (kind == "secret") & canon.rlike("^[0-9a-f]+$")
    swapped = _same_class(canon, stream, hex_only)
    n = F.char_length(canon)
    head = F.substring(F.lit("23456789"), _byte(stream, F.lit(127)) % 8 + 1, F.lit(1))
    numbered = F.when(canon.rlike("^[0-9]"), F.concat(head, F.substring(swapped, F.lit(2), n))).otherwise(swapped)
    # places beyond the entity's own length
    longer = F.greatest(attempt - (ATTEMPTS - 1), F.lit(0))
    tail = F.when(longer > 0, F.array_join(F.transform(F.sequence(F.lit(1), longer), lambda i: (_byte(stream, i + 63) % 10).cast("string")), "")).otherwise("")
    card = F.concat(F.substring(canon, 1, 1), F.substring(swapped, F.lit(2), n - 2), tail)
    # the last digit makes the check come out as the original's did
    check = F.pmod(_luhn(canon) - _luhn(F.concat(card, F.lit("0"))), F.lit(10))
    octet = lambda i: F.when(canon.rlike(r"^(10|127|192\.168|169\.254)\.") & F.lit(i < 2) & (attempt < ATTEMPTS), F.element_at(F.split(canon, r"\.", -1), i + 1)).otherwise((_byte(stream, F.lit(i)) % 223 + 1).cast("string"))
    script, gender = F.element_at(F.split(kind, ":", -1), -1), F.element_at(F.split(kind, ":", -1), 2)
    syllables = lambda s, count: F.array_join(F.transform(F.sequence(F.lit(0), count - 1), lambda i: _pick(SYLLABLES[s], _byte(stream, i))), "")
    family = reduce(lambda rest, s: F.when(script == s, F.concat(syllables(s, 3 + attempt), F.lit(ENDINGS[s, "n"]))).otherwise(rest), SYLLABLES, F.lit(None).cast("string"))
    given = F.lit(None).cast("string")
    for (s, g), end in ENDINGS.items():
        names = GIVEN.get((s, g)) or [*GIVEN[s, "m"], *GIVEN[s, "f"]]
        made = F.concat(syllables(s, 1 + attempt), F.lit(end))
        given = F.when((script == s) & (gender == g), F.when(attempt < 2, F.lower(_pick(names, _byte(stream, F.lit(0))))).otherwise(made)).otherwise(given)
    return (F.when(kind == "email", F.concat(_same_class(F.substring_index(canon, "@", 1), stream, F.lit(False)), tail, F.lit("@"), label, F.when(tld.isin("com", "net", "org"), F.concat(F.lit(".example."), tld)).otherwise(".example")))
            .when(kind == "card", F.concat(card, check.cast("string")))
            .when(kind == "ip", F.concat_ws(".", *[octet(i) for i in range(4)]))
            .when(kind == "key", F.concat(F.lit("AKIA"), F.substring(swapped, F.lit(5), n), tail))
            .when(kind == "iban", F.concat(F.substring(canon, 1, 2), F.substring(swapped, F.lit(3), n), tail))
            .when(kind.startswith("given:"), given).when(kind.startswith("family:"), family)
            .when(kind == "secret", F.concat(swapped, tail)).otherwise(F.concat(numbered, tail)))


def _pool(kind: Column) -> Column:
    """Kinds whose surrogates are checked together: all names of a script, else the kind."""
    return F.when(kind.rlike("^(given|family):"), F.concat(F.lit("name:"), F.element_at(F.split(kind, ":", -1), -1))).otherwise(kind)


def _settled(piece: DataFrame) -> DataFrame:
    """Given names with the gender that most mentions of the full name have; with none, or as many of each, neutral."""
    parts = F.split("kind", ":", -1)
    given = piece.where(F.col("kind").startswith("given:")).withColumn("gender", F.get(parts, F.lit(1)))
    votes = given.groupBy(F.col("person").alias("of")).agg(F.count_if(F.col("gender") == "m").alias("m"), F.count_if(F.col("gender") == "f").alias("f"))
    gender = F.when(F.col("m") > F.col("f"), "m").when(F.col("f") > F.col("m"), "f").otherwise("n")
    same = given.join(votes, given["person"] == votes["of"]).withColumn("kind", F.concat_ws(":", F.lit("given"), gender, F.get(parts, F.lit(2))))
    rest = piece.where(F.col("kind").isNull() | ~F.col("kind").startswith("given:"))
    return rest.drop("person").unionByName(same.select(*[c for c in piece.columns if c != "person"]))


def surrogates(entities: DataFrame, key: str, attempts: int | None = None) -> DataFrame:
    """(kind, canon, surrogate) for distinct entities (kind, canon), without collisions.

    Of several entities that draw the same surrogate, the one that sorts first keeps it.
    A limit of ``attempts`` raises an error if it leaves entities; without one they draw on.
    """
    pending = entities.select("kind", "canon", F.lit(0).alias("attempt"))
    taken = entities.select(_pool(F.col("kind")).alias("pool"), F.col("canon").alias("surrogate")).distinct()
    done = None
    for _ in count() if attempts is None else range(attempts):
        drawn = stage(pending.withColumn("surrogate", _candidate(F.col("kind"), F.col("canon"), F.col("attempt"), key)), "pii-drawn")
        first = drawn.groupBy(_pool(F.col("kind")).alias("pool"), "surrogate").agg(F.min(F.struct("kind", "canon")).alias("own"))
        good = first.join(taken, ["pool", "surrogate"], "left_anti")
        if done is not None:
            good = good.join(done.select(_pool(F.col("kind")).alias("pool"), "surrogate"), ["pool", "surrogate"], "left_anti")
        good = good.select("own.kind", "own.canon", "surrogate")
        good = stage(good, "pii-good")
        done = good if done is None else stage(done.unionByName(good), "pii-done")
        pending = drawn.join(good, ["kind", "canon"], "left_anti").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return done
    raise RuntimeError(f"entities without a surrogate after {attempts} attempts")


def _laid_out(kind: Column, canon: Column, form: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the mention."""
    skip = F.char_length(F.regexp_replace(form, r"[^\p{L}\p{Nd}]", "")) - F.char_length(canon)  # a prefix that the canon leaves out

    def one(c: Column, i: Column) -> Column:
        at = F.char_length(F.regexp_replace(F.substring(form, F.lit(1), i), r"[^\p{L}\p{Nd}]", "")) - skip
        return F.when(c.rlike(r"[\p{L}\p{Nd}]") & (at >= 0), F.substring(surrogate, at + 1, F.lit(1))).otherwise(c)

    # what is longer than the entity stands at the end
    shaped = F.concat(F.array_join(F.transform(F.split(form, "", -1), one), ""), F.substring(surrogate, F.char_length(canon) + 1, F.char_length(surrogate)))
    upper = (F.upper(form) == form) & (F.lower(form) != form)
    cased = F.when(upper & (F.char_length(form) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return (F.when(kind.isin("phone", "card", "ssn", "iban"), shaped)
            .when(kind.startswith("given:") | kind.startswith("family:"), cased)
            .when(kind == "email", F.when(upper, F.upper(surrogate)).otherwise(surrogate)).otherwise(surrogate))


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every entity of ``text_col`` replaced; ``count_col`` adds the number of mentions.

    Who knows ``key`` can look entities up by their surrogates, so it is a secret and has no default.
    """
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    t, i = inner[names.index(text_col)], inner[names.index(id_col)]
    rows = docs.toDF(*inner)
    maybe = F.coalesce(F.col(t).rlike(MAYBE), F.lit(False))
    some = rows.where(maybe).withColumn("sha", F.sha1(F.col(t).cast("binary")))
    mention = some.select(F.col(i).alias("id"), "sha", F.posexplode(F.regexp_extract_all(F.col(t), F.lit(PATTERN), F.lit(0))).alias("pos", "raw"))
    piece = (mention.withColumn("kind", _kind(F.col("raw"))).where("kind is not null or raw is not null")
             .select("id", "sha", "pos", F.lower(F.regexp_replace("raw", rf"^(?:{_TITLE})\.? ", "")).alias("person"), F.posexplode(_pieces(F.col("raw"), F.col("kind"))).alias("part", "p"))
             .select("id", "sha", "pos", "part", "p.kind", "p.canon", "p.form", "p.spaced", F.when(F.col("p.kind").startswith("given:"), F.col("person")).alias("person")))
    piece = stage(_settled(stage(piece.distinct(), "pii-mentions")), "pii-settled")
    mapping = surrogates(piece.where("kind is not null").select("kind", "canon").distinct(), key)
    # a part that stands in many documents is a hot key of an inner join, which Spark splits
    new = piece.where("kind is not null").join(mapping, ["kind", "canon"]).select("id", "sha", "pos", "part", "spaced", _laid_out(F.col("kind"), F.col("canon"), F.col("form"), F.col("surrogate")).alias("s"))
    kept = piece.where("kind is null").select("id", "sha", "pos", "part", "spaced", F.col("form").alias("s"))
    by_row = new.unionByName(kept).groupBy("id", "sha").agg(F.array_sort(F.collect_list(F.struct("pos", "part", "spaced", "s"))).alias("parts"))
    last = F.size("gaps") - 1
    joined = (some.join(by_row, some[i].eqNullSafe(by_row["id"]) & (some["sha"] == by_row["sha"]), "left")
              .select(*inner, "parts").withColumn("gaps", F.split(F.col(t), PATTERN, -1)))
    said = F.transform("gaps", lambda g, k: F.concat(g, F.array_join(F.transform(F.filter("parts", lambda p: p["pos"] == k), lambda p: F.concat(F.when(p["spaced"], " ").otherwise(""), p["s"])), "")))
    text = F.when(F.col("parts").isNull(), F.col(t)).otherwise(F.array_join(said, ""))
    counted = [F.when(F.col("parts").isNull(), 0).otherwise(last).cast("long").alias("n")] if count_col else []
    out = joined.select(*[text.alias(t) if c == t else F.col(c) for c in inner], *counted)
    rest = rows.where(~maybe).select(*inner, *([F.lit(0).cast("long").alias("n")] if count_col else []))
    return out.unionByName(rest).toDF(*names, *([count_col] if count_col else []))
