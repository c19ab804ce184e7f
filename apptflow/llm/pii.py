"""PII: keyed surrogates for detected entities, with DataFrame functions only.

One pattern finds all entities. Every distinct entity gets a surrogate of its type,
format, script and (for names) gender, made from a keyed hash. Surrogates are checked:
no two entities of a type may share one and none may be an entity that occurs; those
that fail are drawn again with the next attempt number. An entity has the same
surrogate wherever it stands, so references stay consistent; names are replaced part by
part, so "Anna Berg" and "Ms. Berg" stay one person, and a part of a name found in a text
is replaced wherever it stands as a word in that text ("Berg left").

Texts without an entity take part in no shuffle. The others are looked up by entity
(a hot entity is one row on the other side, and adaptive execution splits its rows)
and put together from the pieces between their entities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptflow.llm.common import stored

KEY = "change-me"
LONGER_AFTER = 24
#: surrogates that one task makes, and tasks that make them at most
ROWS_A_PART = 1000
MOST_PARTS = 2000

# Given names of surrogates by gender and script; surnames are syllables.
FEMALE = ["Anna", "Clara", "Elena", "Emma", "Eva", "Flora", "Greta", "Helen", "Irene", "Julia", "Laura", "Lena", "Maria", "Nora", "Olga", "Petra", "Rosa", "Sara", "Sofia", "Vera"]
MALE = ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Henry", "Hugo", "Ivan", "Jakob", "John", "Karl", "Leo", "Martin", "Oscar", "Paul", "Peter", "Robert", "Victor"]
FEMALE_CYRILLIC = ["Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья"]
MALE_CYRILLIC = ["Алексей", "Борис", "Виктор", "Глеб", "Иван", "Игорь", "Павел", "Пётр", "Сергей", "Фёдор"]
SYLLABLES = ["bel", "cor", "dan", "fer", "gal", "hol", "kel", "lin", "mar", "nor", "pel", "ran", "sol", "tor", "ven", "wal"]
SYLLABLES_CYRILLIC = ["бел", "вер", "гор", "дан", "зор", "кал", "лин", "мар", "нов", "пол", "рос", "сол", "тар", "фед", "хол", "чер"]
# Given names that are found, by gender; names that are also common words or
# places (May, Hope, Paris) are left out, those of either gender have no gender.
KNOWN_FEMALE = sorted({*FEMALE, *FEMALE_CYRILLIC, *(
    "Abigail Adele Agnes Alice Alicia Alina Amanda Amelia Amelie Amy Ana Andrea Angela Angelika Anita Ann Anne Annette Annika "
    "Antonia Astrid Audrey Aurelie Barbara Beatrice Beatriz Bertha Betty Birgit Brenda Brigitte Camille Carla Carmen Carol Carolina Caroline "
    "Caterina Catherine Cecilia Celine Charlotte Chiara Chloe Christina Christine Claire Claudia Cornelia Cristina Cynthia Daniela "
    "Deborah Denise Diana Donna Doris Dorothy Edith Eleanor Elisa Elisabeth Elise Elizabeth Ella Ellen Elsa Emilia Emily Erika "
    "Esther Eugenie Evelyn Fatima Fiona Francesca Franziska Frieda Gabriela Gabriele Gerda Gisela Giulia Gloria Hanna Hannah "
    "Heather Heidi Heike Helena Helga Hilda Ines Inge Ingrid Isabel Isabella Isabelle Jacqueline Jana Jane Janet Jennifer Jessica Joan "
    "Johanna Josefine Joyce Juana Judith Julie Juliette Karen Karin Katharina Katherine Kathleen Katja Katrin Kelly Kimberly "
    "Klara Kristina Lara Lea Leah Leonie Linda Lisa Louise Lucia Lucie Lucy Luisa Luise Lydia Madeleine Magdalena Manon "
    "Margaret Margarita Margot Marie Marina Marion Marlene Marta Martha Martina Mary Mathilde Megan Melanie Melissa Mia Michelle Michele "
    "Monica Monika Monique Nadia Nancy Natalie Nathalie Natalia Nicole Nina Olivia Pamela Patricia Paula Pauline Pilar Rachel Rebecca "
    "Regina Renate Rita Ruth Sabine Sabrina Samantha Sandra Sarah Sharon Shirley Silvia Simone Sonja Sophia Sophie Stefanie "
    "Stephanie Susan Susanne Sylvia Sylvie Tamara Tanja Tatiana Teresa Theresa Ursula Valentina Valerie Vanessa Veronica "
    "Veronika Victoria Virginie Yvonne Zoe Александра Анастасия Валентина Екатерина Евгения Ксения Людмила Лариса Надежда "
    "Наталья Светлана Татьяна Юлия"
).split()})
KNOWN_MALE = sorted({*MALE, *MALE_CYRILLIC, *(
    "Aaron Adrian Alain Alan Albert Alberto Alejandro Alessandro Alex Alexander Alexandre Alfred Ali Alvaro Anders Andreas Andrew "
    "Antoine Anton Antonio Anthony Arnold Arthur Axel Ben Benedikt Benjamin Benoit Bernard Bernd Bernhard Boris Brandon Brian "
    "Carlos Cesar Charles Christian Christoph Christophe Christopher Claude Claus Daniel Dennis Didier Diego Dieter Dirk Dmitri "
    "Dominik Donald Douglas Edgar Eduardo Edward Enrique Eric Erich Erik Ernst Eugen Fabian Fernando Florian Francesco Francis "
    "Francisco Francois Franz Fred Frederick Friedrich Fritz Gabriel Gary George Georges Gerald Gerard Gerhard Gilles Giovanni "
    "Giuseppe Gregor Gregory Guido Guillaume Gunther Gustav Hans Harald Harold Heinrich Heinz Helmut Henri Herbert Hermann "
    "Horst Hubert Ian Ignacio Igor Jacob Jacques James Jan Jason Javier Jean Jeffrey Jens Jeremy Jerome Jerry Jesus Joachim Joe "
    "Joel Johann Johannes Jonas Jonathan Jorge Jose Joseph Joshua Juan Julian Julien Jens Justin Kai Kenneth Kevin Klaus Konrad "
    "Kurt Larry Lars Laurent Lawrence Leon Leonardo Liam Louis Luca Lucas Ludwig Luigi Luis Lukas Manfred Manuel Marc Marcel "
    "Marco Mario Marius Marcus Markus Mathieu Matteo Matthew Matthias Max Maximilian Michael Michel Miguel Mohamed Mohammed "
    "Moritz Nathan Nicholas Nicolas Niels Nikolai Noah Norbert Olaf Oliver Olivier Otto Pablo Pascal Patrick Paolo Pedro Philip "
    "Philipp Philippe Pierre Rafael Rainer Ralf Ralph Ramon Raymond Ricardo Richard Roberto Roger Roland Rolf Roman Ronald Rudolf "
    "Ryan Samuel Scott Sebastian Sergei Sergio Simon Stefan Stephan Stephen Steven Sven Theo Theodor Thierry Thomas Tim Timothy "
    "Tobias Tom Tomas Udo Ulrich Uwe Vincent Vladimir Walter Werner Wilhelm William Wolfgang Xavier Yves Александр Андрей "
    "Антон Василий Владимир Дмитрий Евгений Константин Максим Михаил Николай Олег Роман Юрий"
).split()})
KNOWN_EITHER = ["Jamie", "Kim", "Morgan", "Robin", "Sasha", "Саша", "Taylor", "Toni"]
# Titles that stand before a name, those that tell the gender and others.
TITLES_FEMALE = ["Mrs.", "Mrs", "Ms.", "Ms", "Miss", "Frau", "Mme.", "Mme", "Mlle", "Madame", "Mademoiselle", "Señora", "Señorita", "Sra.", "Srta.", "Dra.", "Doña", "Lady", "Dame", "Fräulein", "Signora", "Госпожа"]
TITLES_MALE = ["Mr.", "Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr.", "Don", "Sir", "Lord", "Signor", "Господин"]
TITLES = ["Dr.", "Dr", "Prof.", "Prof", "Professor", "Professeur", "Profesor", "Doctor", "Doktor", "Docteur", "Mx.", "Mx", "Rev.", "Доктор", "Профессор"]


def _any(words: list[str]) -> str:
    return "|".join(w.replace(".", r"\.") for w in words)


_NAME = r"\p{Lu}\p{L}*+(?:['’\-]\p{Lu}\p{L}*+){0,9}+"
_GIVEN = KNOWN_FEMALE + KNOWN_MALE + KNOWN_EITHER
_TITLED = TITLES_FEMALE + TITLES_MALE + TITLES
_INITIALS = r"(?:\p{Lu}\.[ ]){0,3}"
#: small words inside a name
_PARTICLES = "van|von|der|den|de|del|della|di|da|dos|du|la|le|zu|zur|ten|ter|bin|ibn|al|el"
_PARTICLE = rf"(?:(?:{_PARTICLES})[ ]){{0,3}}"
#: keys that a mark at their start tells
_MARKED = r"gh[pousr]_|github_pat_|glpat-|sk-|[sr]k_(?:live|test)_|xox[abprs]-"


def _by_letter(words: list[str]) -> str:
    """The words as a pattern that tries only those of one first letter."""
    firsts = sorted({w[0] for w in words})
    return "|".join(f"{a}(?:{_any([w[1:] for w in words if w[0] == a])})" for a in firsts)


_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Each branch starts with a test of one character, so that most places of a text fail
# at once.
ENTITY = "|".join(
    [
        # mailboxes, from the start of a run of their characters
        r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+){0,126}\.[A-Za-z]{2,}",
        # keys, accounts and names, from a capital at the start of a word
        r"(?<![\p{L}\d])(?=\p{Lu})(?:AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
        r"|[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){3,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
        rf"|(?:(?:{_by_letter(_TITLED)})\s){{1,3}}{_INITIALS}{_PARTICLE}(?:{_NAME})(?:[ ]{_PARTICLE}(?:{_NAME})){{0,4}}"
        # given names, as many as there are, and the name behind them
        rf"|(?:(?:{_by_letter(_GIVEN)})[ ])(?:(?:{_by_letter(_GIVEN)})[ ]){{0,3}}{_INITIALS}{_PARTICLE}(?:{_NAME}))",
        # secrets behind their key word
        r"(?<![A-Za-z0-9])(?=[PTSApatsk])(?i:password|passwd|token|secret|api_?key)\s{0,2}[=:]\s{0,2}[\"']?[A-Za-z0-9_\-+/]{8,}+",
        # keys with a mark at their start
        rf"(?<![A-Za-z0-9])(?=[gsrx])(?:{_MARKED})[A-Za-z0-9_\-]{{16,}}+",
        # the same written small, without spaces
        r"(?<![\p{L}\d])(?=[a-z]{2}\d{2})[a-z]{2}\d{2}[a-z0-9]{4}\d{7}[a-z0-9]{0,16}(?![A-Za-z0-9])",
        # addresses of eight groups, or fewer with a double colon
        r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{1,4}:)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
        r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
        # numbers: addresses, cards, social security and telephone
        r"(?<![\d.])(?=\d)(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?!\d|\.\d)",
        r"(?<![\d\-])(?=\d)(?:\d{13,19}|\d{4} \d{4} \d{4} \d{4}(?: \d{3})?|\d{4}-\d{4}-\d{4}-\d{4}(?:-\d{3})?|\d{4}[ \-]\d{6}[ \-]\d{5}"
        r"|\d{3}-\d{2}-\d{4})(?![\d\-])",
        r"(?<![\w+])(?=[+(])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,5}){1,4}(?!\d)"
        r"|\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}(?!\d))",
        # dialled in the country, with its 1 or 0 or without
        r"(?<![\w+.\-])(?=\d)(?:(?:1[ .\-])?\d{3}[ .\-]\d{3}[ .\-]\d{4}|1[ .\-]?\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}"
        r"|0\d(?:[ .\-]\d{2}){4}|0\d{2,4}[ /\-]\d{5,8})(?!\d|[.\-]\d)",
    ]
)
#: texts without any of these hold no entity
HINT = (
    rf"[@\d=:]|(?<![A-Za-z0-9])(?=[gsrx])(?:{_MARKED})"
    rf"|(?<![\p{{L}}\d])(?=\p{{Lu}})(?:{_by_letter(_TITLED + _GIVEN)})\s"
)


def kind(value: Column) -> Column:
    """The type of a found entity, from its form alone."""
    digits = F.length(F.regexp_replace(value, r"\D", ""))
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(r"^(?:\d{1,3}\.){3}\d{1,3}$"), "ip")
        .when(value.rlike(r"^(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}$"), "ip6")
        .when(value.rlike(r"^AKIA[0-9A-Z]{16}$"), "secret")
        .when(value.rlike(r"^(?i:password|passwd|token|secret|api_?key)\s{0,2}[=:]"), "secret")
        .when(value.rlike(rf"^(?:{_MARKED})"), "secret")
        .when(value.rlike(r"^\+") | value.rlike(r"^\(\d{3}\)"), "phone")
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(value.rlike(r"^(?:1[ .\-])?\d{3}[ .\-]\d{3}[ .\-]\d{4}$|^1[ .\-]?\("), "phone")
        .when(value.rlike(r"^0\d(?:[ .\-]\d{2}){4}$|^0\d{2,4}[ /\-]\d{5,8}$"), "phone")
        # a bare number is a card only with a right check digit: "Build 1234567890123" is none
        .when(value.rlike(r"^\d+$") & (digits >= 13) & ~_luhn_valid(value), "none")
        .when(value.rlike(r"^\d(?:[ \-]?\d)+$") & (digits >= 13), "card")
        .when(value.rlike(r"^[A-Z]{2}\d{2}[ A-Z0-9]{12,}$|^[a-z]{2}\d{2}[a-z0-9]{11,}$"), "iban")
        .otherwise("name")
    )


def _digest(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def _nibbles(digest: Column, i: Column) -> Column:
    """A number from 0 to 255 for place ``i``."""
    return F.conv(F.substring(digest, F.pmod(i * 2, F.lit(60)) + 1, F.lit(2)), 16, 10).cast("int")


def _masked(
    value: Column, digest: Column, keep: Column | None = None, hexadecimal: Column | None = None
) -> Column:
    """Each letter becomes a letter of its case, each digit a digit, from ``keep`` on.

    Where ``hexadecimal`` holds, letters stay within a-f.
    """

    def pick(letters: str, n: Column) -> Column:
        size = F.lit(len(letters)) if hexadecimal is None else F.when(hexadecimal, 6).otherwise(len(letters))
        return F.substring(F.lit(letters), F.pmod(n, size) + 1, F.lit(1))

    def one(c: Column, i: Column) -> Column:
        n = _nibbles(digest, i) + i * 7
        out = (
            F.when(c.rlike(r"[0-9]"), F.pmod(n, F.lit(10)).cast("string"))
            .when(c.rlike(r"[a-z]"), pick("abcdefghijklmnopqrstuvwxyz", n))
            .when(c.rlike(r"[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
            .otherwise(c)
        )
        return out if keep is None else F.when(i < keep, c).otherwise(out)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, the last digit counted once."""
    size = F.length(digits)

    def one(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when((size - 1 - i) % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), one), F.lit(0), lambda a, x: a + x)


def _luhn_valid(number: Column) -> Column:
    return F.pmod(_luhn_sum(F.regexp_replace(number, r"\D", "")), F.lit(10)) == 0


def _card(value: Column, digest: Column) -> Column:
    """Same grouping and first digit; a valid check digit if the number had one."""
    masked = _masked(value, digest, keep=F.lit(1))
    digits = F.regexp_replace(masked, r"\D", "")
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    check = F.pmod(F.lit(10) - F.pmod(_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    valid = _luhn_valid(value)
    fixed = F.concat(F.substring(masked, F.lit(1), F.length(masked) - 1), check.cast("string"))
    return F.when(valid, fixed).otherwise(masked)


def _email(value: Column, digest: Column) -> Column:
    """A masked mailbox at a masked host of a domain that is reserved for examples."""
    box, domain = F.split(value, "@")[0], F.split(value, "@")[1]
    top = F.coalesce(F.nullif(F.regexp_extract(domain, r"\.(com|net|org)$", 1), F.lit("")), F.lit("com"))
    host = _masked(F.split(domain, r"\.")[0], F.reverse(digest))
    return F.concat(_masked(box, digest), F.lit("@"), host, F.lit(".example."), top)


def _ip(digest: Column) -> Column:
    octets = [F.pmod(_nibbles(digest, F.lit(k)), F.lit(223 if k == 0 else 254)) + 1 for k in range(4)]
    return F.concat_ws(".", *[o.cast("string") for o in octets])


def _phone(value: Column, digest: Column) -> Column:
    """Country code or leading 1 or 0 and separators stay; the rest is digits of the hash."""
    led = r"^\+\d{1,3}(?=[ .\-(])|^\+\d|^1(?=[ .\-(])|^0(?=\d(?:[ .\-]\d{2}){4}$|\d{2,4}[ /\-]\d{5,8}$)"
    code = F.length(F.regexp_extract(value, led, 0))
    return _masked(value, digest, keep=code)


def _is_cyrillic(value: Column) -> Column:
    return value.rlike(r"\p{IsCyrillic}")


def _pick(words: list[str], n: Column) -> Column:
    return F.element_at(F.lit(words), (F.pmod(n, F.lit(len(words))) + 1).cast("int"))


def _surname(value: Column, digest: Column, attempt: Column) -> Column:
    """Three or more syllables in the entity's script, in its upper or title case."""

    def of(syllables: list[str]) -> Column:
        steps = F.sequence(F.lit(1), F.lit(3) + attempt.cast("int"))
        return F.array_join(F.transform(steps, lambda i: _pick(syllables, _nibbles(digest, i))), "")

    made = F.when(_is_cyrillic(value), of(SYLLABLES_CYRILLIC)).otherwise(of(SYLLABLES))
    return F.when((value == F.upper(value)) & (F.length(value) > 1), F.upper(made)).otherwise(F.initcap(made))


def _given(value: Column, gender: Column, digest: Column, attempt: Column) -> Column:
    """A given name of the gender and script; later attempts join two of them."""

    def of(female: list[str], male: list[str]) -> Column:
        def name(k: int) -> Column:
            n = _nibbles(digest, F.lit(k)) * 256 + _nibbles(digest, F.lit(k + 1))
            return F.when(gender == "f", _pick(female, n)).when(gender == "m", _pick(male, n)).otherwise(_pick(female + male, n))

        return F.when(attempt < 4, name(0)).when(attempt < 12, F.concat_ws("-", name(0), name(2))).otherwise(
            F.concat_ws("-", name(0), name(2), name(4))
        )

    return F.when(_is_cyrillic(value), of(FEMALE_CYRILLIC, MALE_CYRILLIC)).otherwise(of(FEMALE, MALE))


def _candidate(key: str) -> Column:
    """A surrogate for the entity in columns type, gender, value and attempt."""
    value, attempt = F.col("value"), F.col("attempt")
    digest = _digest(F.lit(key), F.col("type"), value, attempt.cast("string"))
    made = (
        F.when(F.col("type") == "email", _email(value, digest))
        .when(F.col("type") == "ip", _ip(digest))
        .when(F.col("type") == "card", _card(value, digest))
        .when(F.col("type") == "phone", _phone(value, digest))
        .when(F.col("type") == "surname", _surname(value, digest, attempt))
        .when(F.col("type") == "given", _given(value, F.col("gender"), digest, attempt))
        .when(F.col("type") == "iban", _masked(value, digest, keep=F.lit(2)))
        .when(F.col("type") == "ip6", _masked(value, digest, hexadecimal=F.lit(True)))
        .when(F.col("type") == "secret", _masked(value, digest, _lead(value), _is_hex(value)))
        .otherwise(_masked(value, digest))
    )
    # a format with fewer forms than there are entities of it grows longer
    by_name = F.col("type").isin("given", "surname")
    syllables = F.concat(*[_pick(SYLLABLES, _nibbles(digest, F.lit(k))) for k in (26, 27, 28)])
    number = F.conv(F.substring(digest, 1, 12), 16, 10)
    longer = F.concat(F.when(F.col("type") == "email", number).otherwise(F.lit("")), made)
    longer = F.when(F.col("type") == "email", longer).otherwise(
        F.concat(made, F.when(by_name, syllables).otherwise(number))
    )
    return F.when(attempt < LONGER_AFTER, made).otherwise(longer)


def _lead(value: Column) -> Column:
    """Length of a secret's key word with its sign and quote, or of an access key's mark."""
    return F.length(F.regexp_extract(value, rf"^(?:AKIA|{_MARKED}|[A-Za-z_]+\s{{0,2}}[=:]\s{{0,2}}[\"']?)", 0))


def _is_hex(value: Column) -> Column:
    secret = F.regexp_replace(value, r"^[A-Za-z_]+\s{0,2}[=:]\s{0,2}[\"']?", "")
    return secret.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(type, gender, value, surrogate) for distinct (type, gender, value).

    Within a type all surrogates differ, and none is a value that occurs. Of those that
    want the same surrogate the smallest value gets it; the others try again, with twice as
    many attempts at once as in the round before, of which the first that wins counts. What
    is settled is written down, so each round works on the rest alone.
    """
    known = entities.select("type", F.col("value").alias("surrogate")).distinct()
    same = ["type", "value", "gender"]
    settled, attempt, step = None, 0, 1
    open_ = stored(entities.select(*same), "open")
    while (left := open_.count()) or settled is None:
        # few rows, but dear ones: a number of parts that is not joined up again
        parts = max(1, min(MOST_PARTS, left * step // ROWS_A_PART))
        tries = F.explode(F.lit(list(range(attempt, attempt + step)))).alias("attempt")
        tried = open_.select(*same, tries).repartition(parts).withColumn("surrogate", _candidate(key))
        free = tried.join(known, ["type", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        won = free.groupBy("type", "surrogate").agg(F.min(F.struct("value", "gender", "attempt")).alias("w"))
        won = won.select("type", "w.value", "w.gender", "w.attempt", "surrogate")
        won = won.groupBy(*same).agg(F.min(F.struct("attempt", "surrogate"))["surrogate"].alias("surrogate"))
        won = stored(won.select("type", "surrogate", "value", "gender"), "surrogates", left)
        settled = won if settled is None else settled.unionByName(won)
        open_ = stored(open_.join(won.select(*same), same, "left_anti"), "open", left)
        attempt, step = attempt + step, 2 * step
    return settled


def _renamed(piece: Column, by_part: Column) -> Column:
    """``piece`` with each whole word that ``by_part`` has replaced, also within hyphens."""
    word = rf"(?<![\p{{L}}\d])(?:{_NAME})(?![\p{{L}}\d])"

    def one(w: Column) -> Column:
        inner = F.transform(F.split(w, r"(?<=['’\-])|(?=['’\-])"), lambda x: F.coalesce(by_part[x], x))
        return F.coalesce(by_part[w], F.array_join(inner, ""))

    new = F.transform(F.regexp_extract_all(piece, F.lit(f"({word})"), F.lit(1)), one)
    glued = F.zip_with(F.split(piece, word, -1), F.concat(new, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    return F.array_join(glued, "")


def anonymize(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced; all columns and rows stay.

    A null or empty text stays as it is. Repeated rows get the same replacement. Extra
    columns are passed on, also under names used here. The result of an empty table is
    empty. ``n_chars``, if there is one, is not touched.
    """
    text = F.col("text").cast("string")
    may = F.coalesce(text.rlike(HINT), F.lit(False))
    untouched = docs.where(~may)

    # texts that may hold an entity, cut at the entities once; told apart by a hash
    rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    own = docs.where(may).select(
        F.regexp_extract_all(text, F.lit(f"({ENTITY})"), F.lit(1)).alias("found"),
        F.split(text, f"(?:{ENTITY})").alias("pieces"),
        F.sha2(text, 256).alias("text_key"),
        *rest,
    )
    own = stored(own, "pii")

    uses = own.select("text_key", F.posexplode("found").alias("pos", "entity")).distinct()
    uses = uses.withColumn("kind", kind(F.col("entity")))
    # names part by part, behind their title; everything else is one part
    title = F.regexp_extract("entity", rf"^(?:(?:{_by_letter(_TITLED)})\s)+", 0)
    uses = uses.withColumn("title", F.when((F.col("kind") == "name") & (title != ""), title))
    behind = F.substring(F.col("entity"), F.coalesce(F.length("title"), F.lit(0)) + 1, F.length("entity"))
    named = F.split(behind, r"\s")
    parts = F.when(F.col("kind") == "name", named).otherwise(F.array("entity"))
    uses = uses.withColumn("parts", parts)
    has_given = F.col("parts")[0].isin(_GIVEN) | (F.size("parts") > 1)
    uses = uses.select(
        "text_key", "pos", "kind", "title", has_given.alias("has_given"), F.size("parts").alias("n"),
        F.posexplode("parts").alias("part", "value"),
    )
    uses = uses.withColumn("is_last", F.col("part") == F.col("n") - 1).drop("n")
    first = (F.col("part") == 0) & F.col("has_given")
    # a further given name, not the last of the parts
    is_given = first | (F.col("value").isin(_GIVEN) & ~F.col("is_last"))
    of_name = F.when(F.col("value").rlike(rf"^(?:{_PARTICLES})$"), "none").when(is_given, "given").otherwise("surname")
    uses = uses.withColumn("type", F.when(F.col("kind") == "name", of_name).otherwise(F.col("kind"))).drop("is_last")
    by_name = F.when(F.col("value").isin(KNOWN_FEMALE), "f").when(F.col("value").isin(KNOWN_MALE), "m")
    by_title = F.when(F.col("title").rlike(rf"^(?:{_any(TITLES_FEMALE)})\s"), "f").when(
        F.col("title").rlike(rf"^(?:{_any(TITLES_MALE)})\s"), "m"
    )
    gender = F.when(F.col("type") == "given", F.coalesce(by_name, by_title, F.lit("")))
    uses = stored(uses.withColumn("gender", F.coalesce(gender, F.lit(""))).drop("kind", "has_given"), "uses")

    same = ["type", "gender", "value"]
    # small words of names and numbers that turn out to be none stay as they are
    made = surrogates(uses.where("type <> 'none'").select(*same).distinct(), key)
    placed = uses.where("type <> 'none'").join(made, same).unionByName(
        uses.where("type = 'none'").withColumn("surrogate", F.col("value"))
    )
    # the parts of a text's entities in order, then the entities in order
    part = F.struct("pos", "part", F.concat_ws("", F.when(F.col("part") == 0, F.col("title")), "surrogate").alias("s"))
    # parts of names, one surrogate each, for where they stand alone
    name = F.when(
        F.col("type").isin("given", "surname") & F.col("value").rlike(r"^\p{L}[\p{L}'’\-]+$"),
        F.struct("value", "type", "gender", "surrogate"),
    )
    placed = placed.groupBy("text_key").agg(
        F.array_sort(F.collect_list(part)).alias("s"), F.array_sort(F.collect_set(name)).alias("names")
    )
    entity = F.transform(
        F.sequence(F.lit(0), F.size("found") - 1),
        lambda i: F.array_join(F.transform(F.filter("s", lambda x: x["pos"] == i), lambda x: x["s"]), " "),
    )
    fields = [F.col("text") if c == "text" else F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    clean = own.where(F.size("found") == 0).withColumn("text", F.col("pieces")[0]).select(*fields)
    filled = own.where(F.size("found") > 0).join(placed, "text_key").withColumn("new", entity)
    # the first of a value's surrogates counts
    first = F.filter("names", lambda x, i: (i == 0) | (x["value"] != F.element_at("names", F.greatest(i, F.lit(1)))["value"]))
    filled = filled.withColumn(
        "by_part", F.map_from_entries(F.transform(first, lambda x: F.struct(x["value"], x["surrogate"])))
    )
    bare = F.when(F.size("names") > 0, F.transform("pieces", lambda p: _renamed(p, F.col("by_part")))).otherwise(F.col("pieces"))
    filled = filled.withColumn("pieces", bare)
    glued = F.zip_with("pieces", F.concat("new", F.array(F.lit(""))), lambda p, e: F.concat(p, e))
    filled = filled.withColumn("text", F.array_join(glued, "")).select(*fields)
    return untouched.unionByName(clean).unionByName(filled)
