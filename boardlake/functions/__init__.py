"""Column functions: JavaScript-compatible text semantics and posting text rules."""

from .jscompat import (  # noqa: F401
    JsRegexError,
    WORD_BOUNDARY,
    WS,
    js_escape_literal,
    js_regex,
    js_trim,
    py_js_trim,
    truthy_or,
    utf16_len,
)
from .text import (  # noqa: F401
    ashby_compensation,
    id_company,
    job_id,
    lever_title_salary,
    location_type,
    salary_from_full_range,
    salary_from_k_range,
    salary_from_text,
    slugify,
    strip_html,
    title_case_slug,
)
