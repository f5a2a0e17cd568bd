"""Patterns that find personal data in text.

Most patterns start by taking one character of a small class, so a search passes over other
characters quickly. Borders are looked at, not taken, so a match is exactly the value. Where a
pattern looks back for a cue, cheaper tests of the place come first.

Texts may themselves be JSON (a JSON document stored as a string attribute), so the left
border knows JSON escapes: in ``\\nbob@x.com`` the value starts at ``b``, not at ``n``.
"""
from __future__ import annotations

from dataclasses import dataclass

from ..config import Policy


@dataclass(frozen=True)
class Detector:
    name: str
    pattern: str
    normal_form: str = "exact"  # how equal values are brought together before hashing
    needs: str = ""  # what a text must hold for a match: "@", "digit" or nothing


# The left border of a value whose first character has been taken.
_LEFT = r"(?:(?<![0-9A-Za-z].)|(?<=\\[bfnrt].)|(?<=\\u[0-9a-fA-F]{4}.))"

# --- e-mail: letters of any script; possessive, so a long token is read once. The engine goes one call
# deeper for each part of a domain, so domains of more than 30 parts are read letter by letter.
_PART = r"\p{L}\p{N}\p{M}-"
_PARTS = rf"(?:[{_PART}]+\.)"
_MAILBOX = r"\p{L}\p{N}\p{M}._%+\-"
EMAIL = (rf"(?:(?<![{_MAILBOX}\\])|(?<=\\[bfnrt])|(?<=\\u[0-9a-fA-F]{{4}})|(?<=\\)(?![bfnrtu]))"
         rf"[{_MAILBOX}]++@(?:(?={_PARTS}{{30}}[{_PART}])[{_PART}.]+\.\p{{L}}{{2,}}|{_PARTS}{{1,30}}\p{{L}}{{2,}})")

# --- cards: grouped, plain 16 digits, 4-6-5; or the last four after a cue
_CARD_CUE = r"(?i:card|visa|mastercard|amex|discover)[^0-9\n]{0,20}ending(?: in)? "
_AFTER_ENDING = r"(?=\d{3}(?!\d))(?<=ending .|ending in .)"
CREDIT_CARD = (rf"\d(?:(?=\d{{3}}){_LEFT}(?:\d{{3}}(?:(?:-\d{{4}}){{3}}|(?: \d{{4}}){{3}})|(?<=[2-9])\d{{15}}"
               rf"|(?<=3)[47]\d{{2}}[ -]?\d{{6}}[ -]?\d{{5}})(?!\d)"
               rf"|{_AFTER_ENDING}(?<={_CARD_CUE}.)\d{{3}})")

# --- social security numbers: any area number; bare or partial only after a cue
_SSN_CUE = r"(?i:ssn|social security(?: number)?)"
SSN = (rf"\d(?:(?=\d{{2}}[ -]\d{{2}}){_LEFT}\d{{2}}(?:-\d{{2}}-|[ ]\d{{2}} )\d{{4}}(?!\d)"
       rf"|(?=\d{{8}}(?!\d))(?<=[:#= ].)(?<={_SSN_CUE}[:#= ]{{1,3}}.)\d{{8}}"
       rf"|{_AFTER_ENDING}(?<={_SSN_CUE}[^0-9\n]{{0,20}}ending(?: in)? .)\d{{3}})")

# --- dates of birth: a date right after a cue
_MONTH = r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]{0,6}\.?"
_DATE = (rf"(?:\d{{4}}[/.-]\d{{1,2}}[/.-]\d{{1,2}}|\d{{1,2}}[/.-]\d{{1,2}}[/.-]\d{{2,4}}"
         rf"|{_MONTH} \d{{1,2}}(?:st|nd|rd|th)?,? \d{{4}}"
         rf"|\d{{1,2}}(?:st|nd|rd|th)? {_MONTH},? \d{{4}})(?!\d)")
_BIRTH_CUE = (r"(?i:dob|d\.o\.b\.|date of birth|birth ?date|birthday|born on|born)"
              r"(?: is| was)?[:=( ]{1,3}")
DATE_OF_BIRTH = rf"(?=[0-9ADFJMNOS])(?<=[:=( ])(?={_DATE})(?<={_BIRTH_CUE}){_DATE}"

# --- IP addresses; a version 6 address must hold a decimal digit
_OCTET = r"(?:25[0-5]|2[0-4]\d|[01]?\d?\d)"
_OCTET_REST = r"(?:(?<=2)(?:5[0-5]|[0-4]\d|\d?)|(?<=[01])\d{0,2}|(?<=[3-9])\d?)"
_HEX = r"[0-9a-fA-F]{1,4}"
IP_ADDRESS = (rf"[0-9a-fA-F](?:(?<=\d)(?=\d{{0,2}}\.\d){_LEFT}(?<!\d\..){_OCTET_REST}(?:\.{_OCTET}){{3}}(?!\.?\d)"
              rf"|(?=[0-9a-fA-F]{{0,3}}:){_LEFT}(?<!:.)(?<=(?=[0-9a-fA-F:]{{0,39}}\d).)"
              rf"(?:[0-9a-fA-F]{{0,3}}:(?:{_HEX}:){{6}}{_HEX}"
              rf"|[0-9a-fA-F]{{2,3}}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)"
              rf"(?![0-9A-Za-z:]))")

# --- phones: North American with separators, or international with a plus sign
_LINE = r"\d{3}[ .-]\d{4}"
_AREA = r"(?:\(\d{3}\)[ .-]?|\d{3}[ .-])"
_EXTENSION = r"(?:(?: ?x ?| ext\.? ?)\d{1,5})?"
PHONE = (rf"[+(0-9](?:(?<=\d)(?=[\d .(-]{{3}}){_LEFT}(?:\d{{2}}[ .-]{_LINE}|(?<=1)[ .-]?{_AREA}{_LINE})"
         rf"|(?<=\()\d{{3}}\)[ .-]?{_LINE}"
         rf"|(?<=\+)(?:1[ .-]?{_AREA}{_LINE}"
         rf"|(?=(?:[ .()-]{{0,2}}\d){{8}})\d{{1,3}}(?: ?\(\d{{1,4}}\))?"
         rf"(?:(?: \d{{1,5}}){{2,5}}(?![.-]\d)|(?:-\d{{2,8}}){{2,4}}|(?:\.\d{{2,8}}){{2,4}}"
         rf"|[ .-]?\d{{6,12}})))(?!\d){_EXTENSION}")

# --- postal addresses: number, street words, street kind; then unit, city, state, zip.
# Street kinds, unit words and directions.
STREET_KINDS = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Boulevard", "Blvd", "Drive",
                "Dr", "Lane", "Ln", "Court", "Ct", "Place", "Pl", "Way", "Terrace", "Ter",
                "Parkway", "Pkwy", "Highway", "Hwy", "Circle", "Cir", "Square", "Sq", "Trail",
                "Trl", "Loop", "Alley", "Plaza", "Row", "Walk")
UNIT_WORDS = ("Apartment", "Apt", "Suite", "Ste", "Unit", "Floor", "Fl", "Room", "Rm",
              "Building", "Bldg")
_STREET_WORD = r"(?:\p{Lu}[\p{L}\p{M}'-]*\.?|\d{1,3}(?:st|nd|rd|th)|of|the|de|la)"
_CITY_WORD = r"\p{Lu}[\p{L}\p{M}'-]*\.?"
_CITY_STATE = rf",? +{_CITY_WORD}(?: {_CITY_WORD}){{0,3}},? +[A-Z]{{2}}\b"
_ZIP = r" +\d{5}(?:-\d{4})?(?!\d)"
_DIRECTION = r"(?: (?:NE|NW|SE|SW|N|S|E|W)\b)?"
_UNIT = (rf"(?:,? (?:(?:(?:{'|'.join(UNIT_WORDS)})\b\.? ?#? ?|#)[\p{{L}}\p{{N}}-]+"
         rf"|\d{{1,3}}(?:st|nd|rd|th) Floor))?")
ADDRESS = (rf"[0-9P](?:(?<=\d)(?=\d{{0,5}}[A-Za-z]? [\p{{Lu}}\dotdl]){_LEFT}"
           rf"\d{{0,5}}[A-Za-z]?(?: {_STREET_WORD}){{1,4}}?"
           rf"(?: (?:{'|'.join(STREET_KINDS)})\b\.?{_DIRECTION}{_UNIT}"
           rf"(?:{_CITY_STATE}(?:{_ZIP})?)?|{_UNIT},{_CITY_STATE[2:]}{_ZIP})"
           rf"|(?<=P)(?<![A-Za-z]P)\.?O\.? Box \d{{1,8}}{_UNIT}(?:{_CITY_STATE}(?:{_ZIP})?)?)")

# --- names: capitalised words after a cue. The cues.
HONORIFICS = ("Mr", "Mrs", "Ms", "Miss", "Mx", "Dr", "Prof")
PERSON_WORDS = ("holder", "cardholder", "customer", "client", "patient", "employee", "member",
                "owner", "tenant", "applicant", "beneficiary", "dependent", "dependents",
                "contact", "primary", "secondary", "emergency", "hire", "registered", "recipient",
                "sender", "parent", "guardian", "spouse", "buyer", "seller", "student", "driver",
                "attendee", "signed by", "for")
MAIL_VERBS = ("sent", "emailed", "mailed", "assigned", "addressed", "shipped", "issued", "delivered")
LETTERS = ("request", "complaint", "application", "message", "email", "letter", "call", "order")
_NUMBER = r"(?: #?[^ \n]{1,20})?"
_CUES = "|".join((
    rf"(?i:{'|'.join(PERSON_WORDS)})(?: is)?:?",
    rf"(?i:{'|'.join(MAIL_VERBS)}) to",
    rf"(?i:{'|'.join(LETTERS)}){_NUMBER} from",
    rf"(?i:employee|customer|patient|member){_NUMBER}:"))
# The rest of a word whose capital has been taken; "For" starts the next cue and is no name.
_REST = r"(?!(?<=F)or )(?:['’]\p{Lu})?\p{Ll}[\p{L}\p{M}'’-]*"
_WORD = rf"\p{{Lu}}{_REST}"
_ANY_REST = r"[\p{L}\p{M}'’-]+"
_MORE = rf"(?: (?:(?:van|von|de|da|del|der|la|bin|al) )?(?:{_WORD}|\p{{Lu}}\.))"
NAME = (rf"\p{{Lu}}(?<![^ :=(\"].)(?:"
        rf"(?<=[a-z.] .)(?<=(?:^|[^A-Za-z])(?:{'|'.join(HONORIFICS)})\.? .){_ANY_REST}{_MORE}{{0,3}}"
        rf"|(?<=[:=] ?.|is .)(?<=(?i:name)(?: is|:| :|=) ?.){_ANY_REST}(?: \p{{Lu}}{_ANY_REST}| \p{{Lu}}\.){{0,3}}"
        rf"|(?={_REST}{_MORE})(?<=(?:^|[^A-Za-z])(?:{_CUES}) .){_REST}{_MORE}{{1,3}}"
        rf"|(?<=\(.){_REST}{_MORE}{{1,2}}(?=\))"
        rf"|{_REST}{_MORE}{{1,2}}(?= \((?:SSN|DOB)\b))")

# Longer digit shapes come before shorter ones; names come last.
BUILT_IN = (
    Detector("email", EMAIL, "lower", "@"),
    Detector("credit_card", CREDIT_CARD, "digits", "digit"),
    Detector("ssn", SSN, "digits", "digit"),
    Detector("date_of_birth", DATE_OF_BIRTH, needs="digit"),
    Detector("ip_address", IP_ADDRESS, "lower", "digit"),
    Detector("phone", PHONE, "phone", "digit"),
    Detector("address", ADDRESS, "lower", "digit"),
    Detector("name", NAME, "lower"),
)


def detectors(policy: Policy) -> tuple[Detector, ...]:
    """The detectors of a policy in the order in which they are applied."""
    custom = tuple(Detector(name, f"(?:{pattern})")
                   for name, pattern in policy.custom_patterns.items())
    return custom + tuple(d for d in BUILT_IN if d.name in policy.categories)
