"""Operator 3: personal data replaced by keyed, type-consistent surrogates.

Mentions are found by one pattern (e-mail addresses, telephone and social security
numbers, payment cards, IBANs, IPv4 addresses, access keys and secrets, names after a
title; then the same names without it, in the same document).  A name is any run of capitalised
words and initials, with particles such as "von" that stay; its last word is the surname, and its
initials become short made-up names.  Each mention is one or more *units* (kind, canonical form);
a name is a unit per word or initial.  Units of the whole corpus are written to a dictionary: the surrogate comes from a keyed SHA-512 of key, kind, attempt
and canonical form, and keeps the form: digits stay digits, letters stay letters, cards
satisfy the Luhn rule and IBANs their check digits, name words keep script and gender.  A number in
a card's form that fails the Luhn rule is no card and stays, unless its document also has it as a
secret (after a keyword).

Collision check: a surrogate that two units share, or that is itself a unit of the corpus,
is drawn again (next attempt) until there is none, so different units stay different.  Every
third attempt draws from longer forms (late addresses are IPv6 ones), so that no form runs out;
equal units have equal surrogates everywhere (coreference), in the format of each mention.

Only DataFrame operations are used.  The dictionary and the mentions are broadcast below a
checked number of rows and joined by a shuffle above it.

Defined results: a null text stays null, with no mentions.  Rows with one id and different
texts are handled each on its own, equal rows give equal results.  All other columns stay as
they are, also under names used in here.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, small

BROADCAST_ROWS = 200_000
#: Session setting that names the key; without it each call draws a key of its own.
KEY_SETTING = "spark.tidemark.pii.key"

# Titles of address by gender.
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Señor", "Sr", "Monsieur", "г-н", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "г-жа", "Κυρία"],
    "n": ["Dr", "Prof", "Mx"],
}
# Small words that join or begin surnames.
PARTICLES = ["von", "vom", "van", "der", "den", "dem", "de", "del", "della", "di", "da", "dal", "das", "do", "dos", "du", "des", "la", "le", "las", "los", "lo", "zu", "zum", "zur", "ter", "ten", "te",
             "af", "av", "al", "el", "bin", "ibn", "bint", "ben", "фон", "де", "ван"]
# Syllables that made-up names are put together from, and endings by gender.
SYLLABLES = {
    "latin": ["ba", "be", "bo", "da", "de", "do", "fa", "fi", "ga", "gi", "ka", "ke", "ko", "la", "le", "li", "lo", "ma", "me", "mi", "mo", "na", "ne", "ni", "no", "pa",
              "ra", "re", "ri", "ro", "sa", "se", "si", "so", "ta", "te", "ti", "to", "va", "ve", "vi", "za"],
    "cyrillic": ["ба", "бо", "ва", "ве", "га", "да", "до", "за", "ка", "ко", "ла", "ле", "ли", "ма", "ми", "на", "не", "но", "па", "ра", "ре", "ро", "са", "со", "та", "то"],
    "greek": ["βα", "γα", "δα", "δε", "θε", "κα", "κο", "λα", "λε", "μα", "με", "μι", "να", "νε", "νο", "πα", "ρα", "ρο", "σα", "τα", "τε"],
}
ENDINGS = {
    "latin": {"m": "n", "f": "a", "n": "l", "s": "r"},
    "cyrillic": {"m": "н", "f": "я", "n": "ль", "s": "р"},
    "greek": {"m": "ς", "f": "ία", "n": "ν", "s": "ρ"},
}

_NAME = r"\p{Lu}[\p{L}\p{M}'’-]++"
_TITLE = "|".join(t for g in TITLES.values() for t in g)
_BEFORE, _AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_TITLES = rf"(?:(?:{_TITLE})\.? ){{1,4}}"
# A name word or initial, after particles and initials without a dot; no title of another name.
_WORD = rf"(?:(?:{'|'.join(PARTICLES)}|\p{{Lu}}) )*+(?!(?:{_TITLE})\.? \p{{Lu}})(?:{_NAME}|\p{{Lu}}\.)"
PERSON = rf"{_BEFORE}{_TITLES}{_WORD}(?:(?: |(?<=\.)-?){_WORD})*+"
#: Where a name is cut into words; a word's separator is its first character, if that isn't a letter.
CUT = r"(?= )|(?<=\p{Lu}\.)(?=-?\p{Lu})"
#: What follows a keyword, which may be quoted, and a sign.
SECRET = (r"(?<=[=:\"'\s])(?=[A-Za-z0-9_/+-]{6})(?=[_/+-]*+[A-Za-z0-9])(?<=[=:]\s{0,3}[\"']{0,1})"
          r"(?<=(?i:password|passwd|pwd|secret|token|api_key|apikey)[\"']{0,1}\s{0,3}[=:]\s{0,3}[\"']{0,1})[A-Za-z0-9_/+-]++")
#: Kind and pattern, in the order in which they are tried at a place.
PATTERNS = [
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.){1,10}[A-Za-z]{2,24}+(?![A-Za-z0-9])"),
    ("access_key", rf"{_BEFORE}AKIA[0-9A-Z]{{16}}{_AFTER}"),
    ("secret", SECRET),
    ("secret", rf"{_BEFORE}[0-9A-Fa-f]{{32,}}+{_AFTER}"),
    ("iban", rf"{_BEFORE}[A-Z]{{2}}[0-9]{{2}}(?: ?[0-9A-Z]{{4}}){{3,7}}(?: ?[0-9A-Z]{{1,3}})?{_AFTER}"),
    ("card", rf"{_BEFORE}[0-9]{{4}}([ -]?)[0-9]{{4}}\1[0-9]{{4}}\1[0-9]{{4}}{_AFTER}"),
    ("card", rf"{_BEFORE}3[47][0-9]{{2}}[ -]?[0-9]{{6}}[ -]?[0-9]{{5}}{_AFTER}"),
    ("phone", r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}" + _AFTER),
    ("phone", r"(?<![\p{L}\p{N}+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}" + _AFTER),
    ("ssn", rf"{_BEFORE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_AFTER}"),
    ("ip", r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![\p{L}\p{N}]|\.[0-9])"),
    ("person", PERSON),
]
# The card pattern's own group has another number in the joined pattern.
PATTERN = "|".join(p.replace("([ -]?)", "(?<sep>[ -]?)").replace(r"\1", r"\k<sep>") for _, p in PATTERNS)
#: Secrets of which case is no part.
HEX = "^[0-9A-Fa-f]{32,}$"
_DOC = ["_doc", "_hash"]


def _small(df: DataFrame) -> DataFrame:
    return small(df, BROADCAST_ROWS)


def _kind(mention: Column) -> Column:
    """The kind of a mention: that of the first pattern which fits it as a whole."""
    out = F.when(F.lit(False), F.lit(""))
    for kind, p in PATTERNS:
        if kind == "secret":
            continue
        out = out.when(mention.rlike(f"^(?:{p})$"), F.lit(kind))
    return out.otherwise(F.lit("secret"))


def _at(digest: Column, i: Column, n: int | Column) -> Column:
    """A number below ``n`` from the digest's byte pair number i (mod 32)."""
    return (F.conv(F.substring(digest, (i % 32).cast("int") * 4 + 1, F.lit(4)), 16, 10).cast("int") % n).cast("int")


def _pick(chars: str, n: Column) -> Column:
    return F.substring(F.lit(chars), n + 1, F.lit(1))


def _shaped(text: Column, digest: Column, hex_only: Column | None = None) -> Column:
    """Another text of the same form: digits for digits, small and capital letters for those."""
    low, letters = "abcdefghijklmnopqrstuvwxyz", _at
    def one(c: Column, i: Column) -> Column:
        lower = _pick(low, letters(digest, i, F.when(hex_only, 6).otherwise(26) if hex_only is not None else 26))
        return (F.when(c.between("0", "9"), _at(digest, i, 10).cast("string")).when(c.between("a", "z"), lower)
                .when(c.between("A", "Z"), F.upper(lower)).otherwise(c))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """``digits`` with the last one set so that the Luhn sum is a multiple of ten."""
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    def term(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when((F.length(body) - 1 - i) % 2 == 0, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(c.cast("int"))
    total = F.aggregate(F.transform(F.split(body, ""), term), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.concat(body, ((10 - total % 10) % 10).cast("string"))


def _iban(text: Column) -> Column:
    """``text`` with the check digits that its country and account ask for."""
    moved = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, F.lit(1), F.lit(2)), F.lit("00"))
    def step(a: Column, c: Column) -> Column:
        value = F.ascii(c) - F.when(c.between("0", "9"), 48).otherwise(55)
        return (a * F.when(value > 9, 100).otherwise(10) + value) % 97
    rest = F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step)
    return F.concat(F.substring(text, F.lit(1), F.lit(2)), F.lpad((98 - rest).cast("string"), 2, "0"), F.substring(text, F.lit(5), F.length(text)))


def surrogate(kind: Column, canonical: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a unit at an attempt, in canonical form."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, attempt.cast("string"), canonical), 512)
    extra = F.floor(attempt / 3).cast("int")
    longer = lambda text, c: F.concat(text, F.repeat(F.lit(c), extra))
    shaped = _shaped(longer(canonical, "0"), digest)
    host = F.substring_index(canonical, "@", -1)
    labels = F.split(host, r"\.")
    top = F.when(F.element_at(labels, -1).isin("com", "net", "org"), F.element_at(labels, -1)).otherwise(F.lit("com"))
    more = F.concat(F.array_join(F.transform(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), lambda x, i: F.concat(_shaped(x, F.sha2(digest, 512)), F.lit("."))), ""))
    email = F.concat(_shaped(longer(F.substring_index(canonical, "@", 1), "a"), digest), F.lit("@"), more, F.lit("example."), top)
    octet = lambda c, i: (F.when((F.length(c) == 3) | (attempt > 5), 100 + _at(digest, i, 156)).when(F.length(c) == 2, 10 + _at(digest, i, 90)).otherwise(_at(digest, i, 10)).cast("string"))
    ip = F.when(attempt > 20, F.concat_ws(":", F.lit("2001:db8"), *[F.substring(digest, F.lit(4 * i + 1), F.lit(4)) for i in range(6)])).otherwise(F.array_join(F.transform(F.split(canonical, r"\."), octet), "."))
    parts = F.split(kind, ":")                      # name:gender:script
    def name(script: str) -> Column:
        s = SYLLABLES[script]
        body = F.array_join(F.transform(F.sequence(F.lit(0), F.when(parts[1] == "i", 1).otherwise(2) + extra), lambda i: F.element_at(F.array(*map(F.lit, s)), _at(digest, i, len(s)) + 1)), "")
        end = F.element_at(F.create_map(*[F.lit(x) for kv in ENDINGS[script].items() for x in kv]), parts[1])
        return F.initcap(F.concat(body, F.coalesce(end, F.lit(""))))
    return (F.when(kind == "email", email)
            .when(kind == "ip", ip)
            .when(kind == "card", _luhn(F.concat(F.substring(canonical, F.lit(1), F.lit(1)), F.substring(shaped, F.lit(2), F.length(shaped)))))
            .when(kind == "phone", F.concat((2 + _at(digest, F.lit(31), 8)).cast("string"), F.substring(shaped, F.lit(2), F.length(shaped))))
            .when(kind == "ssn", F.concat(F.lit("9"), F.substring(shaped, F.lit(2), F.length(shaped))))
            .when(kind == "iban", _iban(F.concat(F.substring(canonical, F.lit(1), F.lit(2)), F.substring(shaped, F.lit(3), F.length(shaped)))))
            .when(kind == "access_key", F.concat(F.lit("AKIA"), F.substring(shaped, F.lit(5), F.length(shaped))))
            .when(kind == "secret", _shaped(longer(canonical, "a"), digest, canonical.rlike("^([0-9a-f]+|[0-9A-F]+)$")))
            .when(parts[2] == "cyrillic", name("cyrillic")).when(parts[2] == "greek", name("greek")).otherwise(name("latin")))


def dictionary(units: DataFrame, key: str) -> DataFrame:
    """The written table (kind, canonical, surrogate) of distinct units, without collisions: no two
    units of a kind have one surrogate (name kinds count as one), and none is itself a unit."""
    group = F.split("kind", ":")[0]
    state = materialise(units.select("kind", "canonical").distinct().withColumn("attempt", F.lit(0)).withColumn("surrogate", surrogate(F.col("kind"), F.col("canonical"), F.col("attempt"), key)), "surrogates")
    while True:
        taken = (state.groupBy(group.alias("g"), F.lower("surrogate").alias("s")).agg(F.min(F.struct("attempt", "kind", "canonical")).alias("first"), F.count("*").alias("n")).where("n > 1").select("g", "s", "first"))
        real = state.select(group.alias("g"), F.lower("canonical").alias("s")).distinct()
        marked = state.withColumn("g", group).withColumn("s", F.lower("surrogate"))
        twice = marked.join(taken, ["g", "s"]).where("struct(attempt, kind, canonical) != first").select("kind", "canonical")
        same = marked.join(real, ["g", "s"], "left_semi").select("kind", "canonical")
        clash = materialise(twice.union(same).distinct(), "clashes")
        if clash.isEmpty():
            return state.select("kind", "canonical", "surrogate")
        again = state.join(clash.withColumn("again", F.lit(1)), ["kind", "canonical"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("again", F.lit(0))).drop("again", "surrogate")
        state = materialise(again.withColumn("surrogate", surrogate(F.col("kind"), F.col("canonical"), F.col("attempt"), key)), "surrogates")


def _word(piece: Column) -> Column:
    """The canonical form of a piece of a name: no separator, no dot of an initial."""
    return F.regexp_replace(F.regexp_replace(piece, "^[ -]", ""), r"^(\p{Lu})\.$", "$1")


def _names(words: Column, initials: Column) -> Column:
    """The pattern of a document's name words, and of its initials that lead to one of them."""
    word = F.concat(F.lit(rf"{_BEFORE}(?:"), F.array_join(words, "|"), F.lit(rf"){_AFTER}"))
    after = F.concat(F.lit(r"(?:\p{Lu}(?:\.[ -]?| )){0,4}(?:"), F.array_join(words, "|"), F.lit(rf"){_AFTER}"))
    initial = F.concat(F.lit(rf"{_BEFORE}(?:"), F.array_join(initials, "|"), F.lit(r")(?:\.(?=[ -]?"), after, F.lit(")|(?= "), after, F.lit("))"))
    return F.when(F.size(words) == 0, "(?!)").when(F.size(initials) == 0, word).otherwise(F.concat(word, F.lit("|"), initial))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).when(word.rlike(r"\p{IsGreek}"), F.lit("greek")).otherwise(F.lit("latin"))


def _gender(mention: Column) -> Column:
    title = F.regexp_replace(F.substring_index(mention, " ", 1), r"\.", "")
    return F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f").otherwise("n")


def _canonical(kind: Column, mention: Column) -> Column:
    digits = F.regexp_replace(mention, "[^0-9]", "")
    return (F.when(kind == "email", F.lower(mention)).when(kind.isin("card", "ssn"), digits)
            .when(kind == "phone", F.when(F.length(digits) > 10, F.substring(digits, F.length(digits) - 9, F.lit(10))).otherwise(digits))
            .when(kind == "iban", F.regexp_replace(mention, " ", "")).when((kind == "secret") & mention.rlike(HEX), F.lower(mention)).otherwise(mention))


def _rendered(kind: Column, mention: Column, canonical: Column, sur: Column) -> Column:
    """The surrogate in the format of the mention: separators, prefixes and the case of hex digits
    stay; what a longer surrogate has more goes to the place of the first character."""
    extra = F.length(sur) - F.length(canonical)
    def filled(cls: str) -> Column:
        left = lambda i: F.length(F.regexp_replace(F.substring(mention, i + 2, F.length(mention)), f"[^{cls}]", ""))
        return F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c.rlike(f"^[{cls}]$") & (left(i) == F.length(canonical) - 1), F.substring(sur, F.lit(1), extra + 1))
                                        .when(c.rlike(f"^[{cls}]$") & (left(i) < F.length(canonical)), F.substring(sur, F.length(sur) - left(i), F.lit(1))).otherwise(c)), "")
    return (F.when(kind.isin("card", "ssn", "phone"), filled("0-9")).when(kind == "iban", filled("0-9A-Z"))
            .when(((kind == "email") | (kind == "secret") & mention.rlike(HEX)) & (mention == F.upper(mention)), F.upper(sur))
            .when((kind == "secret") & mention.rlike(HEX), F.array_join(F.transform(F.split(sur, ""), lambda c, i: F.when(F.substring(mention, i + 1, F.lit(1)).between("A", "F"), F.upper(c)).otherwise(c)), ""))
            .otherwise(sur))


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text")).where("_text is not null")


def _same_doc(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on (_doc, _hash), nulls equal; the right side's key columns go."""
    r = right.withColumnRenamed("_doc", "_doc2").withColumnRenamed("_hash", "_hash2")
    return left.join(r, F.col("_doc").eqNullSafe(F.col("_doc2")) & (F.col("_hash") == F.col("_hash2")), how).drop("_doc2", "_hash2")


def find_mentions(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: mentions (_doc, _hash, i, mention) in text order, the patterns of documents
    that have names (_doc, _hash, names), and the kinds of name words (_doc, _hash, canonical, kind)."""
    texts = _texts(docs, doc_id, text)
    persons = texts.select(*_DOC, F.explode(F.array_distinct(F.regexp_extract_all("_text", F.lit(PERSON), F.lit(0)))).alias("mention"))
    split = persons.select(*_DOC, _gender(F.col("mention")).alias("g"), F.filter(F.transform(F.split(F.regexp_replace("mention", f"^{_TITLES}", ""), CUT), _word), lambda w: w.rlike(r"^\p{Lu}")).alias("w"))
    # The surname is found once a name, before its words become rows.
    surname = F.element_at(F.filter("w", lambda w: F.length(w) > 1), -1)
    word = split.where(F.size("w") > 0).withColumn("last", F.when(F.exists("w", lambda w: F.length(w) > 1), surname)).select(*_DOC, "g", "last", F.explode("w").alias("canonical"))
    role = F.when(F.length("canonical") == 1, "i").when(F.col("canonical") == F.col("last"), "s").otherwise(F.col("g"))
    kinds = materialise(word.select(*_DOC, "canonical", F.concat(F.lit("name:"), role, F.lit(":"), _script(F.col("canonical"))).alias("kind"))
                        .groupBy(*_DOC, "canonical").agg(F.min("kind").alias("kind")), "name-words")
    quoted = F.concat(F.lit(r"\Q"), F.col("canonical"), F.lit(r"\E"))
    names = materialise(kinds.groupBy(*_DOC).agg(_names(F.array_sort(F.collect_set(F.when(F.length("canonical") > 1, quoted))), F.array_sort(F.collect_set(F.when(F.length("canonical") == 1, quoted)))).alias("names")), "name-patterns")
    plain = texts.select(*_DOC, F.posexplode(F.regexp_extract_all("_text", F.lit(PATTERN), F.lit(0))).alias("i", "mention"))
    if names.isEmpty():
        return materialise(plain.distinct(), "mentions"), names, kinds
    some = _small(names)
    named = _same_doc(texts, some, "inner").select(*_DOC, F.posexplode(F.regexp_extract_all("_text", F.concat(F.lit(PATTERN + "|"), F.col("names")), F.lit(0))).alias("i", "mention"))
    return materialise(_same_doc(plain, some.select(*_DOC), "left_anti").union(named).distinct(), "mentions"), names, kinds


def _cards(mentions: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mentions without numbers that only look like cards, and those (_doc, _hash, i, new, real),
    which stand for themselves.  Of a number that its document also has after a keyword, every
    occurrence there is a secret."""
    doubt = (F.col("kind") == "card") & ~F.call_function("luhn_check", F.col("canonical"))
    odd = materialise(mentions.where(doubt).select(*_DOC, "i", "mention"), "no-cards")
    told = (_same_doc(texts, _small(odd.select(*_DOC).distinct()), "left_semi")
            .select(*_DOC, F.explode(F.array_distinct(F.regexp_extract_all("_text", F.lit(SECRET), F.lit(0)))).alias("said")))
    told = _small(materialise(_same_doc(odd, told, "inner").where("mention = said").select(*_DOC, "i").distinct(), "secret-numbers"))
    keys = told.toDF("_doc2", "_hash2", "i2")
    same = F.col("_doc").eqNullSafe(F.col("_doc2")) & (F.col("_hash") == F.col("_hash2")) & (F.col("i") == F.col("i2"))
    secret = odd.join(keys, same, "left_semi").select(*_DOC, "i", "mention", F.lit("secret").alias("kind"), F.col("mention").alias("canonical"))
    left = odd.join(keys, same, "left_anti").select(*_DOC, "i", F.col("mention").alias("new"), F.lit(False).alias("real"))
    sure = mentions.where(~doubt).select(*_DOC, "i", "mention", "kind", "canonical")
    return sure.unionByName(secret), left


def replace_mentions(docs: DataFrame, key: str | None = None, doc_id: str = "doc_id", text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``; ``count`` names an added column with the number of mentions.
    ``key`` is what surrogates follow from: the session's setting if none is given, else a new
    random one, so that nobody can look surrogates up (and no two calls agree on them)."""
    key = key or docs.sparkSession.conf.get(KEY_SETTING, None) or secrets.token_hex(32)
    mentions, names, kinds = find_mentions(docs, doc_id, text)
    typed = mentions.withColumn("kind", _kind(F.col("mention")))
    # Name mentions: every word that the document has as a name, with or without a title.
    words = (_same_doc(mentions.select(*_DOC, "i", "mention"), _small(names.select(*_DOC)), "left_semi").where(F.col("mention").rlike(rf"^(?:{PERSON}|{_NAME}|\p{{Lu}}\.?)$"))
             .select(*_DOC, "i", F.posexplode(F.split("mention", CUT)).alias("j", "piece")).withColumn("word", _word(F.col("piece"))))
    k = kinds.toDF("_doc2", "_hash2", "canonical", "kind")
    named = words.join(_small(k), F.col("_doc").eqNullSafe(F.col("_doc2")) & (F.col("_hash") == F.col("_hash2")) & (F.col("word") == F.col("canonical")), "left").drop("_doc2", "_hash2")
    named = materialise(named, "name-mentions")
    mixed = named.where("kind is not null").select(*_DOC, "i").distinct().withColumn("is_name", F.lit(True))
    m2 = mixed.toDF("_doc2", "_hash2", "i2", "is_name")
    other = (typed.join(_small(m2), F.col("_doc").eqNullSafe(F.col("_doc2")) & (F.col("_hash") == F.col("_hash2")) & (F.col("i") == F.col("i2")), "left_anti")
             .where("kind != 'person'").withColumn("canonical", _canonical(F.col("kind"), F.col("mention"))))
    other, left = _cards(other, _texts(docs, doc_id, text))
    table = dictionary(other.select("kind", "canonical").union(named.where("kind is not null").select("kind", "canonical")), key)
    small = _small(table)
    done = other.join(small, ["kind", "canonical"]).select(*_DOC, "i", _rendered(F.col("kind"), F.col("mention"), F.col("canonical"), F.col("surrogate")).alias("new"), F.lit(True).alias("real"))
    # Separators and the dots of initials stay.
    piece = F.when(F.col("surrogate").isNull(), F.col("piece")).otherwise(F.concat(F.regexp_extract("piece", "^[ -]?", 0), "surrogate", F.when(F.col("piece").endswith(".") & ~F.col("word").endswith("."), ".").otherwise("")))
    done_names = (named.join(small, ["kind", "canonical"], "left").groupBy(*_DOC, "i")
                  .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("j", piece.alias("w")))), lambda x: x["w"]), "").alias("new"), F.max(F.col("kind").isNotNull()).alias("real")).where("real"))
    subs = materialise(done.union(done_names).union(left).groupBy(*_DOC).agg(F.array_sort(F.collect_list(F.struct("i", "new", "real"))).alias("subs")), "replacements")
    per = _same_doc(subs, _small(names), "left") if not names.isEmpty() else subs.withColumn("names", F.lit(None).cast("string"))
    out_names = docs.columns
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in out_names]).alias("_row"), F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    joined = _same_doc(boxed, _small(per), "left")
    def stitched(pattern: Column) -> Column:
        gaps = F.split("_text", pattern, -1)
        found = F.transform("subs", lambda x: x["new"])
        return F.array_join(F.zip_with(gaps, found, lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")
    plain = stitched(F.lit(PATTERN))
    new = F.when(F.col("subs").isNull(), F.col("_text")).when(F.col("names").isNull(), plain).otherwise(stitched(F.concat(F.lit(PATTERN + "|"), F.col("names"))))
    cols = [new.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in out_names]
    return joined.select(*cols, *([F.coalesce(F.size(F.filter("subs", lambda x: x["real"])), F.lit(0)).cast("long").alias(count)] if count else []))
