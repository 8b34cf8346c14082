"""Pages of an interface that isn't there."""

import json

PAGES = {
    "x://a?1": {"total": 3, "link": [{"relation": "next", "url": "x://a?2"}], "entry": [{"resource": {"resourceType": "Location", "id": "1"}}, {"resource": None}]},
    "x://a?2": {"link": [{"relation": "next", "url": "x://a?1"}], "entry": [{"resource": {"resourceType": "Location", "id": "2"}}, {"resource": {"resourceType": "Location"}}]},
    "x://b?1": {"total": 0, "entry": []},
}


def fetch(url):
    return json.dumps(PAGES[url])
