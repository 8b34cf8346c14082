import pytest
from pyspark.sql import functions as F

from rosterlake.functions import documents, fhir
from rosterlake.functions import text as tx


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())) if values else spark.range(1)
    return df.select(expr.alias("x")).first().x


c = F.col


@pytest.mark.parametrize(("npi", "ok"), [("1710588744", True), ("1194013169", True), ("1234567890", False), ("171058874", False), ("17105887441", False), ("abcdefghij", False), ("", False), (None, False)])
def test_npi(spark, npi, ok):
    assert one(spark, tx.npi_valid(c("a")), a=npi) is ok


def test_names_and_credentials(spark):
    assert one(spark, tx.name_part(c("a")), a="Ada  Lund, APRN, FNP-C") == "Ada Lund" and one(spark, tx.credential_part(c("a")), a="Ada Lund, APRN,, FNP-C") == "APRN, FNP-C"
    assert one(spark, tx.credential_part(c("a")), a="Ada Lund") == "" and one(spark, tx.credential_part(c("a")), a=None) is None
    assert sorted(one(spark, tx.credential_tokens(c("a")), a="M.D., F.A.C.P.")) == ["FACP", "MD"]
    assert one(spark, tx.merged_credentials(c("a"), c("b")), a="", b="Ada, MD") == "MD" and one(spark, tx.merged_credentials(c("a"), c("b")), a="MD", b="Ada, md, md, PhD, PHD") == "MD, PhD"
    assert one(spark, tx.last_name(c("a")), a="Ada B Lund Jr.") == "Lund" and one(spark, tx.last_name(c("a")), a="Lund Jr") == "Jr" and one(spark, tx.first_name(c("a")), a="Lund") is None
    assert one(spark, tx.title_case(c("a")), a="menezes-ruiz o'brien") == "Menezes-Ruiz O'Brien"


def test_phone_address_and_keys(spark):
    for p in ("(407) 646-7070", "4076467070", "1-407-646-7070"):
        assert one(spark, tx.clean_phone(c("a")), a=p) == "407-646-7070"
    assert one(spark, tx.clean_phone(c("a")), a="12345") is None
    key = tx.address_key(c("a"), F.lit("fl"), c("z"))
    assert {one(spark, key, a=x, z="32803-1234") for x in ("601 East Rollins Street", "601 E. Rollins St.", "601 east  rollins st")} == {"601 e rollins st|FL|32803"}
    assert one(spark, key, a=None, z="32803") is None and one(spark, key, a="1 x", z="none") is None
    assert one(spark, tx.org_key(c("a")), a=" A  b ") == "a b" and one(spark, tx.org_key(c("a")), a="") is None and one(spark, tx.org_key(c("a")), a="  ") == ""


def test_domains_and_pages(spark):
    assert one(spark, tx.candidate_domains(c("a")), a="Acme Widgets") == ["acmewidgets.com", "acmewidgets.org"]
    assert one(spark, tx.candidate_domains(c("a")), a="Mercy Medical Center") == ["mercymedicalcenter.com", "mercymedicalcenter.org", "mercymedical.com", "mercymedical.org"]
    assert one(spark, tx.candidate_domains(c("a")), a=None) == []
    assert one(spark, tx.page_mentions(c("a"), c("b")), a="Welcome to MERCY", b="Mercy Hospital") is True and one(spark, tx.page_mentions(c("a"), c("b")), a="x", b=None) is False
    assert one(spark, tx.names_match(c("a"), c("b"), c("d")), a="Ada Lund", b="Ada", d="Lund") is True and one(spark, tx.names_match(c("a"), c("b"), c("d")), a="Ada Lund", b="Ada", d=None) is None


def test_documents(spark):
    card = "BEGIN:VCARD\r\nFN:Ada Lund\r\nTEL;TYPE=work:407.646.7070\r\nADR;TYPE=work:;;1 Main St;Town;FL;32803;US\r\nEND:VCARD"
    v = one(spark, documents.parse_vcard(c("a")), a=card)
    assert (v.name, v.phone, v.address, v.zip) == ("Ada Lund", "407-646-7070", "1 Main St", "32803")
    assert one(spark, documents.parse_vcard(c("a")), a="hello") is None
    page = '<script type="application/ld+json">[{"@type":["Thing","Physician"],"name":"A"}]</script>'
    assert one(spark, documents.jsonld_text(documents.jsonld_node(c("a")), "name"), a=page) == "A"
    assert one(spark, documents.jsonld_text(documents.jsonld_node(c("a")), "name"), a="<script type='application/ld+json'>{bad") is None
    assert one(spark, documents.location_ids(c("a")), a="?location=9&location=10&location=9") == ["10", "9"]
    assert [one(spark, documents.body_kind(c("a")), a=x) for x in (' {"a":1}', "<?xml?>", "<html>", None)] == ["json", "xml", "html", "other"]


def test_references(spark):
    assert one(spark, fhir.reference(c("a"))["id"], a="https://x/r4/Location/9/_history/2") == "9"
    assert one(spark, fhir.reference(c("a")), a="#9") is None and one(spark, fhir.reference(c("a")), a="9") is None
    v = F.parse_json(c("a"))
    assert one(spark, fhir.concept_text(v), a='{"coding":[{"display":"D"}]}') == "D" and one(spark, fhir.accepting_new_patients(v), a="{}") is None
    role = '{"extension":{"url":"newpatients","extension":[{"url":"acceptingPatients","valueCodeableConcept":{"coding":{"code":"nopt"}}}]}}'
    assert one(spark, fhir.accepting_new_patients(v), a=role) is False
    t = F.from_json(c("a"), "array<struct<primary:boolean,desc:string>>")
    assert one(spark, fhir.taxonomy_desc(t), a='[{"desc":"x"},{"primary":true}]') is None and one(spark, fhir.taxonomy_desc(t), a='[{"desc":"x"}]') == "x"
