"""Personal-data patterns and the three protection techniques, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One pattern per information type.
PATTERNS = {
    "EMAIL_ADDRESS": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]{1,255}\.[A-Za-z]{2,24}",
    "PHONE_NUMBER": r"(?:\+[0-9]{8,15}|(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})",
    "CREDIT_CARD_NUMBER": r"(?:[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})",
    "IP_ADDRESS": r"(?:[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}|\b(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
                  r"|\b[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)",
}
# The same matches, found in linear time on long texts: a name is tried only where one
# begins and gives nothing back. With a context word in front the plain form is used.
_LINEAR = {"EMAIL_ADDRESS": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]{1,255}\.[A-Za-z]{2,24}"}
# What every match holds: a cheap test that spares most texts the pattern.
_HINTS = {
    "EMAIL_ADDRESS": r"@",
    "PHONE_NUMBER": r"[0-9][ .-][0-9]{3}[ .-][0-9]{4}|\)[ .-][0-9]{3}[ .-][0-9]{4}|\+[0-9]{8}",
    "CREDIT_CARD_NUMBER": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}|3[47][0-9]{2}[ -]?[0-9]{6}",
    "IP_ADDRESS": r"[0-9]\.[0-9]{1,3}\.[0-9]|:[0-9A-Fa-f:]",
}
CONTEXT = r"(?:[Ee]-?mail|[Mm]ail|[Tt]el|[Pp]hone|[Cc]all|[Cc]ard|[Ii][Pp])[:. ]{1,3}"
LIKELIHOODS = ("POSSIBLE", "LIKELY", "VERY_LIKELY")


def _pattern(info_type: str) -> str:
    return _LINEAR.get(info_type, PATTERNS[info_type])


def _matches(text: Column, info_type: str, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(_HINTS[info_type]), found).when(text.isNotNull(), F.array().cast("array<string>"))


def find(text: Column, info_type: str) -> Column:
    """All matches of one type in the whole text, in order."""
    return _matches(text, info_type, _pattern(info_type))


def find_with_context(text: Column, info_type: str) -> Column:
    """As ``find``, each match with a context word in front kept if there is one."""
    return _matches(text, info_type, f"(?:{CONTEXT})?{PATTERNS[info_type]}")


def luhn_valid(number: Column) -> Column:
    """Checksum of a card number; separators are ignored."""
    digits = F.split(F.reverse(F.regexp_replace(number, "[^0-9]", "")), "")
    values = F.transform(
        F.filter(digits, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)),
    )
    return F.aggregate(values, F.lit(0), lambda total, v: total + v) % 10 == 0


def ip_in_range(ip: Column) -> Column:
    return F.contains(ip, F.lit(":")) | F.forall(F.split(ip, r"\."), lambda octet: octet.try_cast("int") <= 255)


def likelihood(info_type: Column, value: Column, has_context: Column) -> Column:
    """A pattern hit is LIKELY; a checksum or context word lifts it, a loose form lowers it."""
    card = info_type == "CREDIT_CARD_NUMBER"
    ip = info_type == "IP_ADDRESS"
    phone = info_type == "PHONE_NUMBER"
    return (
        F.when(ip & ~F.when(ip, ip_in_range(value)).otherwise(True), "POSSIBLE")
        .when(has_context, "VERY_LIKELY")
        .when(card & F.when(card, luhn_valid(value)).otherwise(False), "VERY_LIKELY")
        .when(phone & ~F.startswith(value, F.lit("+")), "POSSIBLE")
        .otherwise("LIKELY")
    )


# ---- masking (irreversible)


def mask_email(value: Column) -> Column:
    """maria@example.com -> m****@*******.com"""
    local = F.substring_index(value, "@", 1)
    domain = F.substring_index(value, "@", -1)
    ending = F.substring_index(domain, ".", -1)
    host = F.left(domain, F.length(domain) - F.length(ending) - 1)
    return F.concat(F.left(local, F.lit(1)), F.repeat(F.lit("*"), F.length(local) - 1),
                    F.lit("@"), F.regexp_replace(host, "[^.]", "*"), F.lit("."), ending)


def _mask_digits(value: Column, keep: int) -> Column:
    head = F.left(value, F.length(value) - keep)
    return F.concat(F.regexp_replace(head, "[0-9]", "*"), F.right(value, F.lit(keep)))


def mask_phone(value: Column) -> Column:
    """+1234567890 -> +*********0"""
    return _mask_digits(value, 1)


def mask_card(value: Column) -> Column:
    """4111111111111111 -> ************1111"""
    return _mask_digits(value, 4)


# ---- generalising


def generalize_ip(value: Column) -> Column:
    """10.20.30.40 -> 10.20.30.0/24, 2001:db8:7:1::9 -> 2001:db8:7::/48"""
    front = F.regexp_extract(value, "^(?:[0-9A-Fa-f]{1,4}:){0,2}[0-9A-Fa-f]{1,4}", 0)
    return F.when(F.contains(value, F.lit(":")), F.concat(front, F.lit("::/48"))).otherwise(
        F.concat(F.substring_index(value, ".", 3), F.lit(".0/24")))


def generalize_year(value: Column) -> Column:
    """1990-05-15 -> 1990"""
    return F.year(value.try_cast("date")).cast("string")


def generalize_address(city: Column, country: Column) -> Column:
    """Street address -> 'CDMX, MX', from the row's own city and country."""
    return F.concat_ws(", ", city, country)


PROTECT = {
    "EMAIL_ADDRESS": mask_email,
    "PHONE_NUMBER": mask_phone,
    "CREDIT_CARD_NUMBER": mask_card,
    "IP_ADDRESS": generalize_ip,
}


def protect_text(text: Column, info_type: str) -> Column:
    """The whole text with every match of the type replaced by its protected form."""
    pieces = F.split(text, _pattern(info_type), -1)
    shown = F.transform(find(text, info_type), PROTECT[info_type])
    woven = F.zip_with(pieces, shown, lambda piece, hidden: F.concat(piece, F.coalesce(hidden, F.lit(""))))
    hit = text.rlike(_HINTS[info_type]) & text.rlike(_pattern(info_type))
    return F.when(hit, F.array_join(woven, "")).otherwise(text)


# ---- tokens (reversible with the key)


def tokenize(value: Column, key: str, key_version: str = "k1") -> Column:
    """Deterministic token: equal values give equal tokens, so joins still work.

    The nonce is derived from key and value. The key is a literal of the plan:
    set ``spark.sql.redaction.string.regex`` where plans are logged.
    """
    nonce = F.unhex(F.substring(F.sha2(F.concat(F.lit(key + "\n"), value), 256), 1, 24))
    sealed = F.aes_encrypt(value, F.lit(key), F.lit("GCM"), F.lit("DEFAULT"), nonce)
    return F.concat(F.lit(key_version + ":"), F.base64(sealed))


def detokenize(token: Column, keys: dict[str, str]) -> Column:
    """Value behind a token; NULL for an unknown key version or a foreign token."""
    version = F.substring_index(token, ":", 1)
    sealed = F.unbase64(F.substring_index(token, ":", -1))
    out = F.lit(None).cast("string")
    for name, key in keys.items():
        opened = F.try_aes_decrypt(sealed, F.lit(key), F.lit("GCM"), F.lit("DEFAULT")).cast("string")
        out = F.when(version == name, opened).otherwise(out)
    return out
