"""Regular expressions in Java syntax. What counts as an e-mail, phone, URL, date range and so on."""

EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
EMAIL_WHOLE = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE = r"\+?\d[\d().\-\s]{7,}\d"
PHONE_CHARACTERS = r"^\+?[0-9().\-\s]{7,}$"
URL = r"(?i)\b(?:https?://|www\.)[^\s<>]+"
YEAR = r"\b(?:19|20)\d{2}\b"
MONTH = r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)[a-z]*\s+\d{4}"
DATE_RANGE = rf"(?i)\b{MONTH}\s*[-to]+\s*(?:(?:present|current)|{MONTH})\b"
FOUR_DIGITS = r"\d{4}"
PLACE_AFTER = r"(?i:(?:^| )(?:in|at|from|based)) ,*\p{Lu}"
SPACE = r"(?U)\s+"
NOT_SPACE = r"(?U)\S"
#: White space that isn't one plain space already.
RAGGED_SPACE = r"(?U) \s+|[^\S ]\s*"
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
SENTENCE_BREAK = r"(?<=[.!?\n])\s+"
SECTION = r"(?i)^(summary|profile|experience|work experience|projects|education|skills|certifications|contact)\b"
LOCATION_LABEL = r"(?i)\b(?:location|city|based in|located in|address)\s*[:\-]?\s*([A-Za-z][A-Za-z\s,.-]{1,80})"
TITLE_ORGANIZATION = r"^([A-Za-z][A-Za-z/&,\-.\s]{1,80}?),\s*([A-Za-z][A-Za-z0-9&.,\- ]{1,80}?)(?:\s+((?:19|20)\d{2}.*|[A-Za-z]{3,9}\s+\d{4}.*))?$"
AT_OR_FROM = r"(?i)\b(?:at|from)\s+([A-Za-z][A-Za-z0-9&.,\- ]{1,100})"
WORKED_AT = r"(?i)\bworked\s+at\s+([A-Za-z][A-Za-z0-9&.,\- ]{1,80}?)(?:\s+from\s+(.+))?$"
DATE_PREFIX = r"^(?:19|20)\d{2}\s+"
SECTION_WORD = r"(?i)\b(?:skills|certifications|projects|education|summary|profile|work experience|experience|last updated)\b"
STUDY_END = r"(?i)\b(?:at|from|in)\b"
BULLETS = ("-", "–", "•", "*")
