from mailspark.functions import dates, headers, html, scoring, text, vectors  # noqa: F401
