"""Regular expressions shared by the text functions, in Java syntax.

``\\w`` and ``\\s`` mean Unicode word and space characters here, which Java's own
shorthands do not, so both classes are spelled out. ``\\b`` is spelled as a pair
of lookarounds for the same reason: its meaning changed between Java releases.
"""

# Bodies of character classes.
WORD = r"a-zA-Z0-9_\p{L}\p{N}"
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"

# The members of SPACE one by one, for functions that take a set of characters.
SPACE_CHARACTERS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

NOT_AFTER_WORD = rf"(?<![{WORD}])"
NOT_BEFORE_WORD = rf"(?![{WORD}])"


def whole_word(body: str, starts: str) -> str:
    """``body`` as a whole word. Nearly all positions are turned down by their first character alone."""
    return rf"(?=[{starts}]){NOT_AFTER_WORD}(?:{body}){NOT_BEFORE_WORD}"


# ---- fixed values: formats that decide what is recognised -----------------------------------

# A mail address can only start where a run of its characters starts, or right behind the
# previous address. Saying so keeps the scan linear on long unbroken runs.
EMAIL = rf"(?:(?<![{WORD}.+-])|\G)[{WORD}.+-]++@[{WORD}-]+\.[{WORD}.-]+"
URL = rf"(?:https?://|www\.)[^{SPACE}]+"
PHONE = rf"(?=[+(0-9\p{{Nd}}])(?<![{WORD}/])\+?\(?\p{{Nd}}[\p{{Nd}}{SPACE}().-]{{8,}}\p{{Nd}}(?![{WORD}/])"
PHONE_DIGITS = (10, 15)

# An apostrophe, straight or typographic: features read texts whose quotes were not made plain.
QUOTE = r"['\u2019\u2018]"

# Job descriptions are read as they are, and there only these two count as an apostrophe after "years".
JOB_QUOTE = r"['\u2019]"

# "3+ years of experience": number, optional range, unit, at most four words, "experience".
def stated_years(quote: str) -> str:
    return (
        rf"(?i)([0-9]{{1,2}})[{SPACE}]*\+?[{SPACE}]*(?:-[{SPACE}]*[0-9]{{1,2}}[{SPACE}]*)?"
        rf"(?:years?|yrs?){quote}?[{SPACE}]+(?:of[{SPACE}]+)?"
        rf"(?:[{WORD}\-/&,]+[{SPACE}]+){{0,4}}?experience"
    )


STATED_YEARS = stated_years(QUOTE)
JOB_STATED_YEARS = stated_years(JOB_QUOTE)
LONGEST_CAREER = 45

MONTH = (
    rf"(?:(?:jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)[a-z]*\.?[{SPACE}]+"
    r"|[0-9]{1,2}[/\-])?"
)
YEAR = r"(?:19|20)[0-9]{2}"
YEAR_SPAN = (
    rf"(?=[12])(?<!\p{{Nd}}){YEAR}[{SPACE}]*(?i:-|\u2013|\u2014|to|till)[{SPACE}]*(?i:{MONTH})"
    rf"(?i:{YEAR}|present|current|now|date)"
)
SPAN_CONTEXT = 50

# A year span this close to one of these words belongs to schooling, not to work.
SCHOOLING_WORDS = (
    rf"university|college|institute|school|academy|b\.?[{SPACE}]?tech|m\.?[{SPACE}]?tech|bachelor|"
    rf"master{QUOTE}?s|master[{SPACE}]+of|b\.?[{SPACE}]?sc|m\.?[{SPACE}]?sc|mba|degree|diploma|cgpa|gpa|"
    rf"graduat[{WORD}]*|ph\.?[{SPACE}]?d"
)
DOCTORATE_WORDS = rf"ph\.?[{SPACE}]?d|doctorate|doctoral"
MASTER_WORDS = (
    rf"master(?:{QUOTE}s|s)?[{SPACE}]+(?:of|in|degree)|master{QUOTE}?s|m\.?[{SPACE}]?tech|m\.?[{SPACE}]?sc|"
    rf"mba|mca|pgdm|post[{SPACE}-]?graduat[{WORD}]*"
)
BACHELOR_WORDS = (
    rf"bachelor(?:{QUOTE}s|s)?|b\.?[{SPACE}]?tech|b\.?[{SPACE}]?sc|b\.?[{SPACE}]?com|bca|bba|"
    rf"under[{SPACE}-]?graduat[{WORD}]*"
)
DIPLOMA_WORDS = "diploma"
# Case-sensitive, so that the word "be" is not a degree.
ENGINEER_WORDS = rf"B\.[{SPACE}]?E"

# Education level by pattern, and the label of each level.
EDUCATION_PATTERNS = (
    (4, whole_word(f"(?i:{DOCTORATE_WORDS})", "dpDP")),
    (3, whole_word(f"(?i:{MASTER_WORDS})", "mpMP")),
    (2, whole_word(f"(?i:{BACHELOR_WORDS})", "buBU")),
    (2, whole_word(ENGINEER_WORDS, "B")),
    (1, whole_word(f"(?i:{DIPLOMA_WORDS})", "dD")),
)
EDUCATION_LABELS = {0: "Not stated", 1: "Diploma", 2: "Bachelor's", 3: "Master's", 4: "PhD"}

ANY_EDUCATION = whole_word(
    f"(?i:{DOCTORATE_WORDS}|{MASTER_WORDS}|{BACHELOR_WORDS}|{DIPLOMA_WORDS})|{ENGINEER_WORDS}", "bdmpuBDMPU"
)
SCHOOLING = whole_word(f"(?i:{SCHOOLING_WORDS})|{ENGINEER_WORDS}", "abcdgimpsuABCDGIMPSU")

# A line that opens the optional part of a job description.
OPTIONAL_HEADING = (
    rf"(?i)(?<![^\n])[{SPACE}]*(?:nice[{SPACE}-]*to[{SPACE}-]*have|"
    rf"preferred(?:[{SPACE}]+(?:qualifications|skills))?|"
    rf"good[{SPACE}-]*to[{SPACE}-]*have|bonus(?:[{SPACE}]+points)?|desirable){NOT_BEFORE_WORD}"
)

TOKEN = rf"[{WORD}]{{2,}}"
