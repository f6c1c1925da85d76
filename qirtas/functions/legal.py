"""Legal text: relation hints, reference types, numbers, topic rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qirtas.functions.text import SPACE, normalize_digits, normalize_whitespace, squeeze

# Words that show a relation, and forms of document types.
AMEND_WORDS = ("amend", "amends", "amending", "amended", "modify", "modifies", "modifying", "modified")
AMEND_ARABIC = ("تعديل", "يعدل", "تعدل", "تستبدل")
REPEAL_WORDS = ("repeal", "repeals", "repealed", "cancel", "cancels", "abolish", "abolishes", "abolished")
REPEAL_ARABIC = ("يلغى", "تلغى", "إلغاء", "إلغاؤه")
DOCUMENT_TYPES = (
    (r"مرسوم\s+سلطاني|royal\s+decree", "Royal Decree"),
    (r"قرار\s+وزاري|ministerial\s+decision", "Ministerial Decision"),
    (r"أمر\s+سامي|الأوامر\s+السامية|royal\s+order", "Royal Order"),
    (r"اتفاقية|معاهدة|agreement|treaty|convention", "Treaty / Agreement"),
    (r"الجريدة\s+الرسمية|official\s+gazette", "Official Gazette"),
    (r"فتوى|legal\s+opinion", "Legal Opinion"),
)
REFERENCE_TYPES = r"مرسوم\s+سلطاني|قرار\s+وزاري|قانون|royal\s+decree|ministerial\s+decision|law|decree"
NUMBER = r"(?:رقم|number|no\.?)?\s*(\d{1,4})\s*/\s*(\d{2,4})"
ISSUER_MARKERS = (
    "وزارة", "وزير", "سلطان عمان", "هيئة", "شرطة", "البنك المركزي",
    "Ministry", "Minister", "Sultan of Oman", "Authority", "Central Bank", "Royal Oman Police",
)
# Topic, confidence, English words, Arabic parts.
TOPIC_RULES = (
    ("Taxation", 0.78, "tax|taxation|taxable|vat|excise", "ضريبة|ضرائب|الدخل"),
    ("Customs", 0.74, "customs|tariff|import|export", "جمارك|تعرفة|استيراد|تصدير"),
    ("Labour Regulation", 0.76, "labou?r|employment|worker|wage|salary", "العمل|عامل|أجور|راتب"),
    ("Omanization", 0.80, "omanization|national workforce", "التعمين|القوى العاملة الوطنية"),
    ("Education", 0.72, "education|school|university|student", "تعليم|مدرسة|جامعة|طالب"),
    ("Public Health", 0.72, "health|medical|hospital|medicine|pharmaceutical", "صحة|طبي|مستشفى|دواء"),
    ("Environmental Protection", 0.73, "environment|pollution|waste|climate", "البيئة|تلوث|نفايات|مناخ"),
    ("Real Estate", 0.73, "real estate|land|property|registry", "عقار|أراض|الأراضي|السجل العقاري"),
    ("Maritime Law", 0.73, "maritime|ship|vessel|port|seafarer", "بحري|سفينة|ميناء|موانئ"),
    ("Banking Regulation", 0.74, "bank|banking|central bank|finance|financial", "بنك|مصرف|المركزي|مالي"),
    ("Competition Law", 0.76, "competition|monopoly|antitrust", "منافسة|احتكار"),
    ("Judicial Administration", 0.71, "judicial|court|judge|prosecution|litigation", "قضاء|محكمة|قاض|الادعاء|دعوى"),
    ("Fees", 0.68, "fee|fees|charge|charges", "رسوم|رسم"),
    ("Investment", 0.70, "investment|investor|capital market", "استثمار|مستثمر|سوق المال"),
    ("Transport", 0.69, "transport|traffic|road|vehicle", "نقل|مرور|طريق|مركبة"),
    ("Criminal Procedure", 0.72, "criminal|penal|crime|procedure", "جزائي|جنائي|جريمة|الإجراءات الجزائية"),
    ("Public Procurement", 0.70, "public procurement|tender|tenders|contract", "مناقصات|المشتريات|عقد"),
    ("Data Protection", 0.70, "data protection|privacy|personal data", "حماية البيانات|الخصوصية|البيانات الشخصية"),
)


def rule_pattern(english: str, arabic: str, group: str = "(") -> str:
    """Whole English words or Arabic parts, in the syntax that Java and RE2 share."""
    return rf"(?i)(?:^|[^\p{{L}}\p{{N}}_]){group}{english})(?:$|[^\p{{L}}\p{{N}}_])|{arabic}"


AMEND_PATTERN = rule_pattern("|".join(AMEND_WORDS), "|".join(AMEND_ARABIC))
REPEAL_PATTERN = rule_pattern("|".join(REPEAL_WORDS), "|".join(REPEAL_ARABIC))


def relation_hint(sentence: Column) -> Column:
    """AMENDS before REPEALS before REFERENCES."""
    return F.when(sentence.rlike(AMEND_PATTERN), "AMENDS").when(sentence.rlike(REPEAL_PATTERN), "REPEALS").otherwise("REFERENCES")


def document_type_label(text: Column) -> Column:
    """The first document type that a text names, or null."""
    return F.coalesce(*[F.when(text.rlike("(?i)" + p), label) for p, label in DOCUMENT_TYPES])


def reference_type_label(raw: Column) -> Column:
    return F.coalesce(document_type_label(raw), F.when(raw.rlike("(?i)قانون|law"), "Law"), normalize_whitespace(raw))


# The forms of dates in text, in the order they are looked for.
DATE_PATTERNS = (
    r"\b\d{4}-\d{2}-\d{2}\b",
    r"\b\d{1,2}\s+[A-Za-z]+\s+\d{4}\b",
    r"\b\d{1,2}\s+من\s+\S+\s+سنة\s+\d{4}\s*هـ?(?:[^\p{L}\p{N}_]|$)",
    r"\b\d{1,2}\s+من\s+\S+\s+سنة\s+\d{4}\s*م(?:[^\p{L}\p{N}_]|$)",
    r"\b\d{1,2}\s*/\s*\d{1,2}\s*/\s*\d{2,4}\b",
)
# Numbers in words, issues of a gazette, and what issues royal decrees.
NUMBER_OF_YEAR = r"(?:royal\s+decree|ministerial\s+decision|decision|decree)\s+(\d{1,4})\s+of\s+(\d{4})"
GAZETTE, GAZETTE_ISSUE = "Official Gazette", r"(?:العدد|issue)\s+(\d{1,5})"
ROYAL, ROYAL_ISSUER = r"(?i)royal decree|مرسوم سلطاني", "Sultan of Oman"
#: Lines at the end of a text that may be a signature.
SIGNATURE_LINES = 50


def document_number(text: Column, document_type: Column | None = None) -> Column:
    """The first n/yyyy of a text, else "n of yyyy" after a type, else the issue of a gazette; or null."""
    t = normalize_digits(text)
    pair = lambda p: F.when(t.rlike("(?i)" + p), F.concat(F.regexp_extract(t, "(?i)" + p, 1), F.lit("/"), F.regexp_extract(t, "(?i)" + p, 2)))
    found = [pair(NUMBER), pair(NUMBER_OF_YEAR)]
    if document_type is not None:
        found.append(F.when((document_type == GAZETTE) & t.rlike("(?i)" + GAZETTE_ISSUE), F.regexp_extract(t, "(?i)" + GAZETTE_ISSUE, 1)))
    return F.coalesce(*found)


def date_in_text(text: Column) -> Column:
    """The first date of a text, as it is written there, or null."""
    t = normalize_digits(text)
    found = [F.regexp_substr(t, F.lit("(?i)" + p)) for p in DATE_PATTERNS]
    # The sign after a date only shows that it has ended.
    return squeeze(F.regexp_replace(F.coalesce(*found), r"([هم]ـ?)[^\p{L}\p{N}_ـ]$", "$1"))


def issuer_of(title: Column, tags: Column, text: Column) -> Column:
    """What a title has before its colon, else the issuer of royal decrees, else a tag or signature line that looks like one."""
    t = squeeze(title)
    prefix = squeeze(F.substring_index(t, ":", 1))
    named = F.when(t.contains(":") & F.length(prefix).between(3, 140), prefix)
    royal = F.when(t.rlike(ROYAL), ROYAL_ISSUER)
    lines = F.filter(F.transform(F.split(text, "\n"), squeeze), lambda x: x != "")
    last = F.reverse(F.slice(lines, F.greatest(F.size(lines) - SIGNATURE_LINES + 1, F.lit(1)), SIGNATURE_LINES))
    first = lambda xs: F.try_element_at(F.filter(xs, looks_like_issuer), F.lit(1))
    return F.coalesce(named, royal, first(F.transform(tags, squeeze)), F.when(F.size(lines) > 0, first(last)))


def looks_like_issuer(text: Column) -> Column:
    t = normalize_whitespace(text)
    found = F.lit(False)
    for marker in ISSUER_MARKERS:
        found = found | F.lower(t).contains(marker.lower())
    return F.length(t).between(3, 180) & found


def split_sentences(text: Column) -> Column:
    """Parts between line breaks, full stops and semicolons, tidied, without empty ones."""
    parts = F.transform(F.split(text, r"[\n.;؛]+"), normalize_whitespace)
    return F.filter(parts, lambda p: p != "")


def language_by_ratio(text: Column) -> Column:
    """Arabic if at least as many Arabic as Latin letters; also for no text."""
    arabic = F.regexp_count(text, F.lit(r"[\x{600}-\x{6FF}]"))
    latin = F.regexp_count(text, F.lit("[A-Za-z]"))
    return F.when(F.coalesce(arabic >= latin, F.lit(True)), "ar").otherwise("en")


def preview(text: Column, length: int = 420) -> Column:
    """One line of at most ``length`` characters, with dots if there was more."""
    t = F.regexp_replace(text, rf"[{SPACE}]+", " ")
    t = F.regexp_replace(t, "^ | $", "")
    return F.when(F.length(t) > length, F.concat(F.substring(t, 1, length), F.lit("..."))).otherwise(t)
