import json

import pytest

from fundloom.sources import connectors as c

AT = "2026-01-01T00:00:00Z"


@pytest.fixture
def land(spark, tmp_path):
    def put(source, page):
        (tmp_path / source).mkdir(exist_ok=True)
        (tmp_path / source / "1.json").write_text(json.dumps(page))
        return c.pages(spark, source, str(tmp_path / source))

    return put


def grant(tables):
    return tables["grant"].orderBy("source_id").collect()


def test_nsf(land):
    a = {"id": "7001", "title": "Ice", "awardeeName": "Uni A", "awardeeCountryCode": "US", "pdPIName": "Ann Bee", "piFirstName": "Ann", "piLastName": "Bee", "coPDPI": ["Cid Dee cd@x.example", "ann bee"], "startDate": "01/15/2020", "expDate": "13/40/2020", "estimatedTotalAmt": "", "fundsObligatedAmt": "0", "divAbbr": "OPP"}
    t = c.graph_tables(c.nsf(land("nsf", {"response": {"award": [a, a]}})), AT)
    g = grant(t)
    assert len(g) == 1 and g[0].amount_usd is None and g[0].currency is None and (g[0].start_date, g[0].end_date) == ("2020-01-15", None)
    assert {p.full_name for p in t["person"].collect()} == {"Ann Bee", "Cid Dee"} and t["field"].first().name == "OPP"
    assert {e.role for e in t["grant_person"].collect()} == {"pi", "co-pi"} or t["grant_person"].count() == 2


def test_nih(land):
    p = {"project_num": "5R01CA1", "award_amount": 0, "project_start_date": "2020-02-03T00:00:00", "organization": {"org_name": "U", "org_country": "UNITED STATES"}, "principal_investigators": [], "agency_ic_admin": {"abbreviation": "NCI", "name": "Cancer"}}
    t = c.graph_tables(c.nih(land("nih", {"results": [p]})), AT)
    assert t["funder"].count() == 2 and t["funder_grant"].count() == 1 and t["person"].count() == 0 and t["organization"].first().country_code == "US"


def test_ukri(land):
    p = {"id": "P1", "title": "t", "leadFunder": "EPSRC", "start": 1580515200000, "end": 0, "researchTopics": {"researchTopic": [{"text": "Unclassified"}, {"text": "Physics"}]}, "participantValues": {"participant": [{"organisationName": "O", "role": "LEAD_X", "grantOffer": 10.5}, {"organisationName": "Q", "role": "P", "grantOffer": 0}]}}
    t = c.graph_tables(c.ukri(land("ukri", {"project": [p]})), AT)
    g = grant(t)[0]
    assert (g.amount_original, g.amount_usd, g.start_date, g.end_date) == (10.5, 13.34, "2020-02-01", None)
    assert [f.name for f in t["field"].collect()] == ["Physics"] and {e.role for e in t["grant_org"].collect()} == {"recipient", "host"}


@pytest.mark.parametrize("deep", [True, False])
def test_czi(land, deep):
    one = [{"id": "c1", "fields": {"Amount": "1,000", "Initiative": ["A", "B"], "Account Name": "Org", "Commitment Year": "2021"}}, {"id": "c2", "fields": {"Amount": 0, "Initiative": "A", "Account Name": "Org"}}]
    t = c.graph_tables(c.czi(land("czi", {"grants": [one] if deep else one})), AT)
    assert [g.amount_usd for g in grant(t)] == [1000.0, None] and t["field"].count() == 2 and t["organization"].count() == 1


def test_cordis_and_erc(spark):
    p = spark.createDataFrame([("1", "t", "o", "2020-01-01T", "2021-01-01", "100", "1500000,50", "SIGNED", "ERC-STG"), ("2", "t2", None, "2020-01-01", "", "2,000.5", "", "CLOSED", "RIA")], "id string,title string,objective string,startDate string,endDate string,totalCost string,ecMaxContribution string,status string,fundingScheme string")
    o = spark.createDataFrame([("1", "Uni", "EL", "Ath", "X", "1.5,2.5", "", "HES", "coordinator"), ("1", "Co", "UK", "L", "Y", "", "", "PRC", "participant")], "projectID string,name string,country string,city string,nutsCode string,geolocation string,organizationURL string,activityType string,role string")
    t = c.graph_tables(c.cordis(p, o), AT)
    assert [(g.amount_original, g.status) for g in grant(t)] == [(1500000.5, "active"), (2000.5, "completed")]
    assert t["funder_grant"].count() == 3 and {(x.country_code, x.lat) for x in t["organization"].collect()} == {("GR", 1.5), ("GB", None)}
    e = c.graph_tables(c.cordis(p, o, erc_only=True), AT)
    assert e["grant"].count() == 1 and e["funder"].first().short_name == "ERC"


def test_pages_and_tables(spark, tmp_path):
    html = '<h1 class="facelift">Big &amp; small</h1><div><span class="name">Term</span><span class="value">from 2019 to 2022</span></div><div><span class="name">Applicant Institution</span><span class="value"><a>Uni X</a></span></div><div><span class="name">Spokesperson</span><span class="value">Professor Dr. Eva Ott</span></div>'
    t = c.graph_tables(c.dfg(spark.createDataFrame([("55", html), (None, html), ("56", None)], "key string, html string")), AT)
    g = grant(t)
    assert (g[0].title, g[0].amount_usd, g[0].end_date, g[0].status) == ("Big & small", None, "2022-12-31", "completed") and t["person"].first().full_name == "Eva Ott" and len(g) == 2
    (tmp_path / "g.csv").write_text('Banner,,\nGRANT ID,GRANTEE,PURPOSE,DIVISION,DATE COMMITTED,DURATION (MONTHS),AMOUNT COMMITTED,GRANTEE WEBSITE,GRANTEE CITY,GRANTEE STATE,GRANTEE COUNTRY,REGION SERVED,TOPIC\nG1,"Org, Inc","do, it",Health,2020-05,18,"1,500",,Paris,,France,GLOBAL,Malaria\nG2,B,p,Health,2020-05,x,,,,,,,\n')
    g = grant(c.graph_tables(c.gates(c.gates_csv(spark, str(tmp_path / "g.csv"))), AT))
    assert [(x.amount_usd, x.end_date, x.program) for x in g] == [(1500.0, "2021-11-01", "Health / Malaria"), (None, None, "Health")]
    card = '<ul><li><header><div class="grantee">Inst</div><div class="amount">$50,000</div><div class="city">Boston, MA</div><div class="year">2019</div></header><a href="/grant-detail/g-1">x</a><ul><li><span class="label">Investigator</span>Jo Doe; Al Roe</li></ul></li></ul>'
    t = c.graph_tables(c.sloan(spark.createDataFrame([(card,)], "html string")), AT)
    assert grant(t)[0].start_date == "2019-01-01" and t["organization"].first().country_code == "US" and t["person"].count() == 2


def test_openalex(land):
    w = {"id": "https://x/W1", "title": "T", "publication_year": 2020, "cited_by_count": 3, "abstract_inverted_index": json.dumps({"b": [1], "a": [0, 2]}), "primary_topic": {"id": "https://x/T1", "display_name": "t", "score": 0.9, "domain": {"id": "https://x/d/1", "display_name": "d"}}, "authorships": [{"author": {"id": "https://x/A1", "display_name": "A"}, "institutions": [{"display_name": "I", "ror": "https://r/0"}]}], "referenced_works": ["https://x/W2", None], "awards": [{"funder_award_id": "R01"}, {"id": "z"}]}
    t = c.openalex(land("openalex", {"results": [w, w]}), AT)
    assert {k: x.count() for k, x in t.items()} == {"work": 1, "person": 1, "organization": 1, "person_org": 1, "field": 2, "work_field": 1, "award": 1, "corpus": 1}
    assert t["corpus"].first().abstract == "a b a" and t["corpus"].first().refs == ["W2"]
    f = {x.level: x for x in t["field"].collect()}
    assert f["topic"].parent_atlas_id == f["domain"].atlas_id  # the nearest ancestor there is


def test_register(land):
    r = land("ror", {"id": "r1", "status": "active", "names": [{"value": "X University", "types": ["ror_display", "label"]}, {"value": "XU", "types": ["acronym"]}], "locations": [{"geonames_details": {"country_code": "US"}}], "external_ids": [{"type": "fundref", "preferred": "5", "all": ["5", "6"]}]})
    assert {(x.name, x.kind, x.country) for x in c.ror_names(r).collect()} == {("X University", "display", "US"), ("XU", "acronym", "US")}
    assert {x.fundref for x in c.fundref(r).collect()} == {"5", "6"}


def test_stream(spark, land, tmp_path):
    from fundloom.streaming.landing import ingest

    land("nih", {"results": [{"project_num": "1", "project_start_date": "2020-02-03", "organization": {"org_name": "U"}}]})
    for _ in range(2):  # the second run finds nothing new
        ingest(spark, "nih", str(tmp_path / "nih"), str(tmp_path / "out"), str(tmp_path / "cp"), c.nih, AT).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "grant")).count() == 1


def test_status_and_sources_pages(spark, land):
    """Status by end date on the day of the run, unknown without one; every row says where it is from."""
    p = lambda k, end: {"project_num": k, "project_end_date": end, "organization": {"org_name": "U"}, "agency_ic_admin": {"abbreviation": "NCI", "name": "Cancer"}}
    t = c.graph_tables(c.nih(land("nih", {"results": [p("1", "2025-12-31"), p("2", "2026-01-01"), p("3", None)]})), AT)
    assert [g.status for g in grant(t)] == ["completed", "active", "unknown"]
    assert all(x.where("source_url is null or source is null or as_of is null").isEmpty() for x in t.values())


def test_bulk_feed_has_no_co_investigators(land):
    a = {"id": "1", "title": "t", "pdPIName": "Ann Bee", "coPDPI": ["Cid Dee"]}
    df = land("nsf", {"response": {"award": [a]}})
    roles = lambda f: sorted(r.role for r in c.graph_tables(f(df), AT)["grant_person"].collect())
    assert roles(c.CONNECTORS["nsf"]) == ["co-pi", "pi"] and roles(c.CONNECTORS["nsf_bulk"]) == ["pi"]


def test_linked_people_and_organisations(spark, land):
    link = lambda rel, href: {"rel": rel, "href": href}
    project = {"id": "P1", "leadFunder": "EPSRC", "identifiers": {"identifier": [{"value": ""}, {"value": "EP/1"}]}, "links": {"link": [link("PI_PER", "http://g/persons/A"), link("COI_PER", "http://g/persons/B"), link("COI_PER", "http://g/persons/gone"), link("FUND", "http://g/f/1"), link("LEAD_ORG", "http://g/organisations/O"), link("COI_PER", None)]}}
    bare = {"id": "P2", "leadFunder": "EPSRC"}
    persons = spark.createDataFrame([("A", "Ann", None, "Bee", None), ("B", "Cid", "D.", "Eff", "0000-1"), ("A", "Ann", None, "Bee", None), (None, "x", None, "y", None)], c.SCHEMAS["ukri_person"])
    orgs = spark.createDataFrame([("O", "Uni O", None)], c.SCHEMAS["ukri_organisation"])
    t = c.graph_tables(c.ukri(land("ukri", {"project": [project, bare]}), persons, orgs), AT)
    assert sorted((p.full_name, p.orcid) for p in t["person"].collect()) == [("Ann Bee", None), ("Cid D. Eff", "0000-1")] and sorted(e.role for e in t["grant_person"].collect()) == ["co-pi", "pi"]
    assert [o.name for o in t["organization"].collect()] == ["Uni O"] and t["person_org"].count() == 2
    assert [g.source_url for g in grant(t)] == ["https://gtr.ukri.org/projects?ref=EP/1", "https://gtr.ukri.org/projects?ref=P2"]


def test_zip_members(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("deep/project.csv", 'id;title;more\n1;"a; b\nc";x\n2;;y\n')
        z.writestr("other.csv", "id\n9\n")
    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("v2.json", json.dumps([{"id": "r1", "status": "active", "names": [{"value": "X", "types": ["ror_display"]}]}, {"id": "r2", "status": "withdrawn", "names": []}]))
        z.writestr("readme.txt", "no")
    got = c.zipped_csv(spark, str(tmp_path / "a.zip"), "project.csv", ["id", "title", "gone"]).collect()
    assert [tuple(r) for r in got] == [("1", "a; b\nc", None), ("2", None, None)]
    assert [r.ror for r in c.ror_names(c.zipped_json(spark, str(tmp_path / "r.zip"), "ror")).collect()] == ["r1"]


def test_files_without_a_header(spark, tmp_path):
    (tmp_path / "g.csv").write_text("Banner,,\nG1,Org,do,Health,2020-05,18,10,,,,Mali,,\n")
    t = c.graph_tables(c.gates(c.gates_csv(spark, str(tmp_path / "g.csv"))), AT)
    assert [(g.source_id, g.amount_usd) for g in grant(t)] == [("G1", 10.0)] and t["organization"].first().country_code == "ML"
