"""Answers of the services for tests, by what is asked."""

import json

DOCS = [{"id": str(i), "source": "MED", "pmid": str(i), "pmcid": f"PMC{i}", "doi": f"10.1/{i}", "title": f"T{i}", "firstPublicationDate": "2024-01-02"} for i in range(5)]


def article(pmcid):
    return f'<article><front><article-meta><article-id pub-id-type="pmcid">{pmcid}</article-id><title-group><article-title>T</article-title></title-group></article-meta></front><body>{"word " * 200}</body></article>'


def transport(service, params):
    if service == "europepmc":
        at = 0 if params["cursorMark"] == "*" else int(params["cursorMark"])
        some = DOCS[at : at + 2]
        return json.dumps({"hitCount": 5, "nextCursorMark": str(at + len(some)), "resultList": {"result": some}})
    if service == "europepmc_links":
        if params["page"] == 3:
            from corpusloom.sources.services import ServiceError

            raise ServiceError(service, "HTTP 500")
        return json.dumps({"hitCount": 5, "citationList": {"citation": [{"id": str(10 * params["page"] + i), "source": "MED"} for i in range(2)]}})
    if service == "biorxiv":
        at, n = params["cursor"], 3
        rows = [{"doi": f"10.2/{i}", "title": "the virus" if i % 2 else "other", "date": "2024-03-01", "version": "1", "server": params["server"]} for i in range(at, min(at + 2, n))]
        return json.dumps({"messages": [{"cursor": at, "total": str(n)}], "collection": rows})
    if service == "biorxiv_doi":
        return json.dumps({"collection": [{"jatsxml": f"http://x/{params['doi']}"}]})
    if service == "chemrxiv_item":
        return json.dumps({"id": params["id"], "asset": {"original": {"url": f"http://x/{params['id']}.pdf"}}})
    if service == "pdf":
        return f"%PDF {params['url']}"
    if service == "jatsxml":
        return article("")
    if service == "chemrxiv":
        at = params["skip"]
        return json.dumps({"totalCount": 3, "itemHits": [{"item": {"id": f"c{i}", "doi": f"10.3/{i}", "title": "C"}} for i in range(at, min(at + 2, 3))]})
    if service == "arxiv":
        at = params["start"]
        entries = "".join(f"<entry><id>http://arxiv.org/abs/24{i}v1</id><title>A</title><published>2024-05-0{i + 1}T00:00:00Z</published></entry>" for i in range(at, min(at + 2, 3)))
        return f'<feed xmlns="http://www.w3.org/2005/Atom" xmlns:o="http://a9.com/-/spec/opensearch/1.1/"><o:totalResults>3</o:totalResults>{entries}</feed>'
    if service == "esearch":
        return json.dumps({"esearchresult": {"count": "2", "idlist": ["1", "2"]}})
    if service == "idconv":
        known = [{"requested-id": i, "pmid": int(i), "pmcid": f"PMC{i}"} for i in params["ids"].split(",") if int(i) >= 10 and int(i) % 2 == 0]
        return json.dumps({"records": [{"requested-id": "1", "pmid": 1, "pmcid": "PMC1", "doi": "10.1/1"}, {"requested-id": "2", "status": "error"}, *known]})
    if service == "efetch":
        return "<pmc-articleset>" + "".join(article(f"PMC{i}") for i in params["id"].split(",") if i != "3") + "</pmc-articleset>"
    if service == "europepmc_text":
        return article("PMC999" if params["id"] == "PMC2" else params["id"])
    return None
