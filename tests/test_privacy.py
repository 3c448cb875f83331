import pytest
from pyspark.sql import functions as F

from store_rows import rows
from mercato.functions import pii
from mercato.operators import privacy

KEY, OTHER = "0123456789abcdef", "fedcba9876543210"


def value(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


@pytest.mark.parametrize("technique, given, want", [
    (pii.mask_email, "maria@example.com", "m****@*******.com"),
    (pii.mask_email, "a@b.example.co", "*@*.*******.co".replace("*@", "a@", 1)),
    (pii.mask_phone, "+1234567890", "+*********0"),
    (pii.mask_phone, "+1 (743) 555-3824", "+* (***) ***-***4"),
    (pii.mask_card, "4111111111111111", "************1111"),
    (pii.mask_card, "4111 1111 1111 1234", "**** **** **** 1234"),
    (pii.generalize_ip, "192.168.1.45", "192.168.1.0/24"),
    (pii.generalize_year, "1990-05-15", "1990"),
    (pii.generalize_year, "unknown", None),
])
def test_techniques(spark, technique, given, want):
    assert value(spark, technique(F.lit(given))) == want
    assert value(spark, technique(F.lit(None).cast("string"))) is None


def test_address(spark):
    assert value(spark, pii.generalize_address(F.lit("CDMX"), F.lit("MX"))) == "CDMX, MX"


def test_tokens(spark):
    a = pii.tokenize(F.lit("maria@example.com"), KEY)
    assert value(spark, a) == value(spark, a) and value(spark, a).startswith("k1:")
    assert value(spark, a) != value(spark, pii.tokenize(F.lit("maria@example.com"), OTHER))
    assert value(spark, a) != value(spark, pii.tokenize(F.lit("maria@example.con"), KEY))
    assert value(spark, pii.detokenize(a, {"k1": KEY})) == "maria@example.com"
    assert value(spark, pii.detokenize(a, {"k1": OTHER})) is None
    rotated = pii.tokenize(F.lit("x"), OTHER, "k2")
    assert value(spark, pii.detokenize(rotated, {"k1": KEY, "k2": OTHER})) == "x"


@pytest.mark.parametrize("number, ok", [("4111111111111111", True), ("4111-1111-1111-1111", True),
                                        ("4111111111111112", False), ("5500 0000 0000 0004", True)])
def test_luhn(spark, number, ok):
    assert value(spark, pii.luhn_valid(F.lit(number))) is ok


TEXT = ("Mail: maria@example.com or pedro.x@mail.example.org, phone +1234567890, +1 (743) 555-3824 and 743-555-3824; "
        "card 4111111111111111, 4111111111111112, ip 192.168.1.45 and 999.1.1.1")


def test_inspect(spark):
    df = spark.createDataFrame([(1, TEXT), (2, "nothing here"), (3, None)], "id int, text string")
    assert rows(privacy.inspect(df, "id", "text")) == [
        ("CREDIT_CARD_NUMBER", 2, 1), ("EMAIL_ADDRESS", 2, 1), ("IP_ADDRESS", 2, 1), ("PHONE_NUMBER", 3, 1)]


def test_likelihood(spark):
    df = spark.createDataFrame([(1, TEXT)], "id int, text string")
    got = {r.value: r.likelihood for r in privacy.rate_findings(df, "id", "text", "POSSIBLE").collect()}
    assert got == {
        "maria@example.com": "VERY_LIKELY", "pedro.x@mail.example.org": "LIKELY", "+1234567890": "VERY_LIKELY",
        "+1 (743) 555-3824": "LIKELY", "743-555-3824": "POSSIBLE", "4111111111111111": "VERY_LIKELY",
        "4111111111111112": "LIKELY", "192.168.1.45": "VERY_LIKELY", "999.1.1.1": "POSSIBLE"}
    assert privacy.rate_findings(df, "id", "text").count() == 7
    assert privacy.rate_findings(df, "id", "text", "VERY_LIKELY").count() == 4


def test_whole_text_is_protected(spark):
    long = "word " * 30_000 + "end maria@example.com"
    df = spark.createDataFrame([(1, TEXT), (2, "nothing"), (3, None), (4, long)], "id int, text string")
    got = {r.id: r.text for r in privacy.protect_texts(df, "text").collect()}
    assert got[2] == "nothing" and got[3] is None
    assert got[4] == "word " * 30_000 + "end m****@*******.com"
    assert got[1].startswith("Mail: m****@*******.com or p******@****.*******.org, phone +*********0,")
    assert privacy.findings(privacy.protect_texts(df, "text"), "id", "text",
                            types=["EMAIL_ADDRESS", "PHONE_NUMBER", "CREDIT_CARD_NUMBER"]).count() == 0


def test_policy_over_columns(spark):
    df = spark.createDataFrame([("c", "maria@example.com", "+1234567890", "Reforma 123", "CDMX", "MX")],
                               "customer_id string, email string, phone string, address string, city string, country string")
    r = privacy.deidentify(df, key=KEY).first()
    assert (r.customer_id, r.phone, r.address) == ("c", "+*********0", "CDMX, MX")
    assert r.email.startswith("k1:")
    with pytest.raises(ValueError):
        privacy.deidentify(df)
    assert privacy.deidentify(df, {"email": "remove"}).first().email is None
    hidden = privacy.deidentify(df, key=KEY)
    assert privacy.inspect_columns(hidden).count() == 0
    assert rows(privacy.inspect_columns(df, {"address": "STREET_ADDRESS"})) == [
        ("address", "STREET_ADDRESS", 1), ("email", "EMAIL_ADDRESS", 1), ("phone", "PHONE_NUMBER", 1)]


def test_policy_over_payload(spark):
    import json

    doc = {"event_id": "e", "email": "maria@example.com", "n": 1.5, "deep": {"email": "x@y.example"}, "none": None, "ip": "10.0.0.9"}
    out = value(spark, privacy.protect_payload(F.lit(json.dumps(doc)), {"email": "mask_email", "ip": "subnet", "zip": "token"}, KEY))
    assert json.loads(out) == doc | {"email": "m****@*******.com", "ip": "10.0.0.0/24", "deep": {"email": "x@*.example"}}


def test_long_names_are_masked_whole(spark):
    name = "n" * 70
    df = spark.createDataFrame([(1, f"write to {name}@example.com or a.b@c.de!")], "id int, t string")
    assert privacy.protect_texts(df, "t", ["EMAIL_ADDRESS"]).first().t == f"write to n{'*' * 69}@*******.com or a**@*.de!"
    assert privacy.findings(df, "id", "t", types=["EMAIL_ADDRESS"]).count() == 2


def test_hints_hold_wherever_a_pattern_does():
    import random
    import re

    rnd = random.Random(3)
    bits = [*"+1 .-():x@", "555", "123", "4567", "3782", "822463", "10005", "4111", "10.1.2.3", "::", "fe80", "a:", "m.n", "b.co"]
    hits = 0
    for _ in range(20_000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 14)))
        for info_type, pattern in pii.PATTERNS.items():
            if re.search(pattern, text):
                hits += 1
                assert re.search(pii._HINTS[info_type], text), (info_type, text)
    assert hits > 2000 and set(pii._HINTS) == set(pii.PATTERNS)


def opened(spark, doc, policy=privacy.DEFAULT_POLICY, key=KEY):
    import json

    text = doc if isinstance(doc, str) else json.dumps(doc)
    return json.loads(value(spark, privacy.protect_payload(F.lit(text), policy, key)))


def test_payload_fields_at_any_depth(spark):
    doc = {"event_id": "e", "city": "Lima", "country": "PE", "address": "Main 1", "note": 'say "email": "x" \\ and \\" {',
           "profile": {"Email": "ana.sol@shop.example", "deep": [{"phone": "+15550001112", "n": [1, {"ip_address": "2001:db8:7:1::9"}]}]},
           "credit_card": 378282246310005, "phone": ["+15550001112", None, "no number"], "email": None, "first_name": 'A"n\\a',
           "list": [{"address": {"street": "x", "city": "Quito", "country": "EC"}}, {"address": {"street": "y"}}]}
    got = opened(spark, doc)
    assert got["note"] == doc["note"] and (got["address"], got["event_id"]) == ("Lima, PE", "e")
    assert got["credit_card"] == "***********0005" and got["phone"] == ["+**********2", None, "*********"]
    assert [x["address"] for x in got["list"]] == ["Quito, EC", None] and got["email"] is None
    assert got["profile"]["deep"] == [{"phone": "+**********2", "n": [1, {"ip_address": "2001:db8:7::/48"}]}]
    hidden = F.lit(got["profile"]["Email"]), F.lit(got["first_name"])
    assert [value(spark, pii.detokenize(h, {"k1": KEY})) for h in hidden] == ["ana.sol@shop.example", 'A"n\\a']
    with pytest.raises(ValueError):
        privacy.protect_payload(F.lit("{}"))


def test_payload_that_cannot_be_read_is_withheld(spark):
    assert opened(spark, {"event_id": "e", "event_type": "t", "email": {"of": {"x": "ana@shop.example"}}}) == {
        "event_id": "e", "event_type": "t", "withheld": True}
    assert opened(spark, {"event_id": "e", "a": {"email": [["ana@shop.example"]]}})["withheld"]
    assert opened(spark, {"email": ["a@b.example"] * 300})["withheld"]
    assert opened(spark, {"email": [], "phone": {}}) == {"email": [], "phone": {}}
    assert opened(spark, {"email": "plain", "ip_address": "none", "phone": True, "credit_card": ""}, {
        "email": "mask_email", "ip_address": "subnet", "phone": "mask_phone", "credit_card": "remove"}) == {
        "email": "*****", "ip_address": None, "phone": "****", "credit_card": None}
    long = {"event_id": "e", "email": "q\"\\" * 50_000, "text": "\\\" [{" * 50_000}
    assert opened(spark, long, {"email": "mask_email"})["text"] == long["text"]
    assert value(spark, privacy.protect_payload(F.lit(None).cast("string"), {"email": "remove"})) is None


def test_failed_messages_are_not_kept_in_clear(spark):
    bad = '{"email": "ana@shop.example", "first_name": "Ana", "x": "+15550001112 3782 822463 10005'
    sealed = privacy.protect_message(F.lit(bad), key=KEY)
    assert value(spark, pii.detokenize(sealed, {"k1": KEY})) == bad
    plain = {"email": "mask_email", "first_name": "remove"}
    assert value(spark, privacy.protect_message(F.lit(bad), plain)) == (
        '{"email": "a**@****.example", "first_name": null, "x": "+**********2 **** ****** *0005')
    assert value(spark, privacy.protect_message(F.lit("at fe80::1 or ana@shop.example"), plain)) == "at fe80::/48 or a**@****.example"
