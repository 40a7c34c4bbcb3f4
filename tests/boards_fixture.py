"""Hand-written landed boards (our own values) in the raw_boards layout."""

import json

RAW_DDL = "ats string, slug string, endpoint string, part int, http_status int, fetched_at timestamp, body string"

GH_BOARD = {
    "name": "Northwind Labs",
    "jobs": [
        {
            "id": 4401, "internal_job_id": 9901, "title": "Senior Data Engineer", "updated_at": "2025-05-02T09:30:00-04:00",
            "absolute_url": "https://boards.example.com/northwind/jobs/4401", "location": {"name": "Remote - US"},
            "departments": [{"name": "Data"}, {"name": "Platform"}], "offices": [{"name": "New York"}],
            "content": "&lt;p&gt;Pay: $140,000 - $180,000 &amp;amp; equity&lt;/p&gt;&lt;ul&gt;&lt;li&gt;SQL&lt;/li&gt;&lt;/ul&gt;",
        },
        {
            "id": 4402, "internal_job_id": None, "title": None, "updated_at": None, "absolute_url": None,
            "location": None, "departments": [], "offices": None, "content": None,
        },
    ],
}

LEVER_BOARD = [
    {
        "id": "lv-1", "text": "Support Lead ($60,000 - $70,000)", "hostedUrl": "https://jobs.example.com/acme/lv-1",
        "createdAt": 1714557600000, "descriptionPlain": "Help customers. $10 - $20", "description": "<p>ignored</p>",
        "categories": {"department": "", "team": "Customer", "location": "Dublin", "commitment": "Full-time"},
        "workplaceType": "onsite",
    },
    {"id": "lv-2", "text": "Analyst", "createdAt": 0, "description": "<b>Numbers</b> $90K - $110K"},
    {"id": "lv-3", "text": "Far future", "createdAt": 9000000000000000, "categories": None},
]

ASHBY_REST = {
    "organizationName": "Glacier",
    "jobs": [
        {"id": "ice-7", "title": "Sledge Builder", "departmentName": "Workshop", "location": "Narvik",
         "descriptionHtml": "<p>Bend ash wood.</p>", "publishedAt": "2029-02-11T05:45:00Z",
         "employmentType": "Contract", "isRemote": True, "teamName": "Frames", "compensation": "$43,210 - $54,321"},
        {"id": "ice-8", "title": "Cook", "compensation": {"min": 7100, "max": 8850, "currency": "CHF"},
         "descriptionHtml": "<p>$1&nbsp;-&nbsp;$2</p>"},
        {"id": "ice-9", "title": "Dog Handler", "compensation": None, "descriptionPlain": "Wage $31,000 - $36,400"},
    ],
}

ASHBY_GQL = {"data": {"jobBoard": {"title": "Glacier GQL", "jobPostings": [
    {"id": "g-1", "title": "Designer", "locationName": "Berlin", "employmentType": "PartTime",
     "descriptionHtml": "<p>Design.</p>", "publishedDate": "2025-04-01", "compensationTierSummary": "€50K – €60K"},
]}}}


def row(ats, slug, endpoint, status, body, part=0):
    return (ats, slug, endpoint, part, status, None, body if isinstance(body, str) or body is None else json.dumps(body))
