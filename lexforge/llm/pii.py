"""Surrogates for personal data: detected entities get keyed, type-consistent replacements.

Entities: e-mail addresses, telephone numbers, IPv4 and IPv6 addresses, payment card numbers, national ids (ddd-dd-dddd),
account numbers (IBAN), secrets (access keys, password= and token= values) and personal names: after a title, made of a known
given name and a surname, or (Chinese, Japanese, Korean) before a title; within a text, each part of a detected name wherever
it stands alone.

A surrogate is the image of the entity under a keyed permutation of all strings of its form, so equal entities get equal
surrogates everywhere (coreference), different ones get different surrogates (distinctness), and no table of all entities
is needed: the operator is one narrow pass. Where a form is defined by a property, the permutation is repeated until the
image has it as well, so that forms don't overlap. What is kept: letter case, script, digits as digits, separators; the kind
of a secret; the card's issuer digit and its Luhn remainder; a phone's country code and the 555 exchange; an address's range,
and which groups of an IPv6 address are zero; an IBAN's country and check remainder. The permutations are single cycles, so no
entity maps to itself.

Names: a known given name maps within its gender and script, by a keyed cycle of the known names; an unknown one whose gender
a title tells becomes a made-up word with an ending of that gender; surnames and other parts keep script and the pattern of
vowels and consonants; the family name of a Chinese or Korean name maps among family names, its other characters among those
usual for the same gender, or among the rest. Distinctness holds for each of these kinds of parts.

Collision checks: within a text, a surrogate that another entity of the kind has already is replaced by the next one of its
cycle (that is the one case in which an entity's surrogate depends on the text); over a corpus, collisions() counts them.

Defined cases: null stays null; an empty text stays empty; texts without an entity stay byte for byte as they are; texts of
any length are scanned whole; of entities that overlap the one that begins first, then the longer, counts; repeated rows
get equal results; loopback addresses stay; a column of docs that has the name of a result is replaced.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import math
import ipaddress
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, replacing

#: Known given names by script and gender; fixed values, common ones and not all that there are.
GIVEN = {
    ("latin", "f"): "Alice Beatrice Charlotte Deborah Eleanor Florence Gabriela Hannah Isabelle Jacqueline Katharina Louise Margaret Natalie Olivia Patricia Rebecca Susanne Theresa Veronica Mary Maria Anna Anne Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Sandra Ashley Emily Michelle Amanda Melissa Stephanie Laura Emma Sophie Julia Ursula Monika Petra Sabine Claudia Martina Marie Camille Nathalie Sylvie Carmen Ana Lucia Pilar Giulia Francesca".split(),
    ("latin", "m"): "Albert Benjamin Christopher Dominic Edward Frederick Gregory Harold Immanuel Jonathan Kenneth Laurence Matthew Nicholas Oliver Patrick Richard Sebastian Theodore Vincent John James Robert Michael William David Joseph Thomas Charles Daniel Anthony Steven Paul Andrew Joshua Kevin Brian George Timothy Ronald Jason Peter Henry Hans Klaus Wolfgang Jürgen Stefan Andreas Martin Pierre Jean Jacques Philippe François Michel José Juan Carlos Luis Miguel Antonio Giovanni Giuseppe".split(),
    ("cyrillic", "f"): "Анна Валентина Галина Екатерина Ирина Людмила Мария Наталья Ольга Светлана Татьяна Юлия".split(),
    ("cyrillic", "m"): "Александр Борис Виктор Григорий Дмитрий Иван Константин Михаил Николай Павел Сергей Юрий".split(),
    ("greek", "f"): "Αικατερίνη Βασιλική Γεωργία Ελένη Ιωάννα Μαρία Σοφία Χριστίνα".split(),
    ("greek", "m"): "Αλέξανδρος Βασίλειος Γεώργιος Δημήτριος Ιωάννης Κωνσταντίνος Νικόλαος Παναγιώτης".split(),
    ("arabic", "f"): "فاطمة عائشة مريم خديجة زينب سارة ليلى نور هدى سلمى".split(),
    ("arabic", "m"): "محمد أحمد علي حسن حسين عمر خالد يوسف إبراهيم محمود".split(),
    ("devanagari", "f"): "अनीता सीता गीता प्रिया पूजा सुनीता रेखा मीना नेहा कविता".split(),
    ("devanagari", "m"): "राम मोहन राजेश सुरेश अमित विजय संजय अनिल राहुल अजय".split(),
    ("hebrew", "f"): "שרה רחל לאה מרים חנה רבקה".split(),
    ("hebrew", "m"): "משה דוד יוסף אברהם יעקב יצחק".split(),
}
#: Titles and the gender they tell, if any; fixed values.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f", "Dr": "", "Prof": "", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f"}
#: Titles of scripts without capitals, before the name, and those that stand behind it.
UNCASED_TITLES = {"السيد": "m", "السيدة": "f", "الدكتور": "m", "الدكتورة": "f", "श्री": "m", "श्रीमती": "f", "डॉ": "", "মিসেস": "f", "জনাব": "m", "מר": "m", "גברת": "f", "คุณ": "", "นาย": "m", "นางสาว": "f", "นาง": "f"}
BEHIND = {"han": {"先生": "m", "女士": "f", "小姐": "f", "太太": "f", "教授": "", "博士": "", "老师": "", "老師": ""}, "kanji": {"さん": "", "様": "", "氏": "", "くん": "m", "君": "m"}, "hangul": {"씨": "", "님": "", "선생": "", "교수": "", "박사": "", "여사": "f"}}
#: Family names, and characters of given names that are usual for a gender.
FAMILIES = {"han": "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕苏卢蒋蔡贾丁魏薛叶阎余潘杜戴夏钟汪田任姜范方石姚谭廖邹熊金陆郝孔白崔康毛邱秦江史顾侯邵孟龙万段雷钱汤尹黎易常武乔贺赖龚文張劉陳楊趙黃吳孫馬羅鄭謝韓馮許蘇盧蔣葉", "hangul": "김이박최정강조윤장임한오서신권황안송류전홍고문양손배백허유남심노하곽성차주우구민진지엄채원천방공현"}
USUAL = {"f": "芳娜敏静丽秀英玉兰霞梅莉娟婷雪琴红艳燕萍珍慧淑嘉媛倩雯", "m": "伟强磊军勇杰涛超刚辉鹏斌峰毅浩宇龙健雄豪栋志威"}
#: Endings of made-up given names.
ENDINGS = {("latin", "f"): "ina", ("latin", "m"): "ius", ("cyrillic", "f"): "ина", ("cyrillic", "m"): "ий", ("greek", "f"): "ίνα", ("greek", "m"): "ιος"}
WHO = {name: (script, gender) for (script, gender), names in GIVEN.items() for name in names}
#: Vowels and consonants of each script: surrogates of surnames exchange a letter for one of its class.
CLASSES = ["aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóú", "äöü", "àèìòù", "âêîôû", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αειουω", "βγδζθκλμνξπρστφχψ", "άέίόύώή"]
#: Ranges of letters; those of a range, case and kind (vowel or not) that are in no class above are one class.
SCRIPTS = {"latin": "À-ɏ Ḁ-ỿ", "greek": "Ͱ-Ͽ ἀ-῿", "cyrillic": "Ѐ-ԯ", "armenian": "Ա-և", "hebrew": "א-ת", "arabic": "ء-ي ٱ-ۓ", "devanagari": "ऄ-औ क-ह", "bengali": "অ-ঔ ক-হ", "thai": "ก-ฮ", "georgian": "Ⴀ-ჿ", "kana": "ぁ-ゖ ァ-ヺ", "hangul": "가-힣", "han": "㐀-䶿 一-鿿"}
VOWELS = set("aeiouyæœøıаеёиоуыэюяіїєαεηιουω")


def in_ranges(ranges: str) -> str:
    return "".join(chr(c) for r in ranges.split() for c in range(ord(r[0]), ord(r[2]) + 1))


def classes() -> dict[str, str]:
    """The class of each letter, as a string of its members; each has two or more."""
    out = {ch: c for group in CLASSES for c in (group, group.upper()) for ch in c}
    usual = {ch: group for group in USUAL.values() for ch in group}
    for script, ranges in SCRIPTS.items():
        found: dict[tuple, list[str]] = {}
        for part in ranges.split():
            for ch in in_ranges(part):
                kind = unicodedata.category(ch)
                if kind in ("Lu", "Ll", "Lo") and ch not in out and ch not in usual:
                    base = unicodedata.normalize("NFD", ch)[0].lower()
                    found.setdefault((part, kind, base in VOWELS), []).append(ch)
        groups = list(found.values())
        for group in groups:
            members = group if len(group) > 1 else group + max(groups, key=len)
            out |= dict.fromkeys(group if len(group) > 1 else members, "".join(members))
    return usual | out


CLASS_OF = classes()


def script_of(word: str) -> str:
    """The script of a word's first letter."""
    return "latin" if word[:1] < "ɐ" else next((k for k, r in SCRIPTS.items() if any(x[0] <= word[0] <= x[2] for x in r.split())), "")


def cased(kind: str) -> str:
    """Letters of a case in the scripts that have it, as ranges of a character class."""
    letters = [c for k in ("latin", "greek", "cyrillic", "armenian") for c in in_ranges(SCRIPTS[k]) if unicodedata.category(c) == kind]
    out: list[list[str]] = []
    for c in letters:
        if out and ord(c) == ord(out[-1][1]) + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"{a}-{b}" for a, b in out)


DIGITS, HEX, HEX_UP, UPPER_DIGITS = "0123456789", "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
HEX_SET, HEX_UP_SET, UPPER_DIGITS_SET = frozenset(HEX), frozenset(HEX_UP), frozenset(UPPER_DIGITS)
LOWER_LETTERS, UPPER_LETTERS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Longer forms go into tweaks as digests, so that the work is in proportion to a value's length.
LONG_FORM = 300
#: Capitalised words of any of the scripts, also with an apostrophe or a capital inside; and initials.
UP, LOW = "A-Z" + cased("Lu"), "a-z" + cased("Ll")
CAP = rf"(?:[{UP}](?:['’][{UP}])?[{LOW}]+(?:[{UP}][{LOW}]+)?(?![{UP}{LOW}])|[{UP}]\.)"
WORDS = re.compile(rf"(?<!\w){CAP}")
#: Words of scripts without capitals, with their marks.
UNCASED = r"[\u05d0-\u05ea\u0620-\u0652\u0671-\u06d3\u0900-\u0963\u0980-\u09e3\u0e01-\u0e4e]+"
HAN, HANGUL = r"\u3400-\u4dbf\u4e00-\u9fff", r"\uac00-\ud7a3"

#: Kind and pattern of each entity; what is replaced is the group `v` if there is one.
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9](?:[\w.+-]{0,62}[\w+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,18}(?![\w-])",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)(?P<v_key>[A-Z0-9]{16})(?![A-Za-z0-9])|(?i:(?<![A-Za-z0-9])(?:password|passwd|pwd|token|secret|api_key|apikey)\b\s{0,3}[=:]\s{0,3}[\"']?)(?P<v_word>[A-Za-z0-9_+/.-]{8,})",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "phone": r"(?<![\w+.-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\d-])|(?<![\w+])\+\d{7,15}(?!\d)",
    "national_id": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "ipv6": r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){0,7}:?(?![\w:])|(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:)?(?::[0-9A-Fa-f]{1,4}){1,7}(?![\w:])",
    "name": rf"(?<!\w)(?P<title>{'|'.join(sorted(TITLES, key=len, reverse=True))})\.? +(?P<v_titled>{CAP}(?:[ -]{CAP}){{0,2}})|(?<!\w)(?P<v_known>(?:{'|'.join(sorted((w for w in WHO if w[0].isupper()), key=len, reverse=True))})(?:[ -]{CAP}){{1,2}})",
    "uncased name": rf"(?<!\w)(?P<before>{'|'.join(sorted(UNCASED_TITLES, key=len, reverse=True))})[ .]+(?P<v_uncased>{UNCASED}(?: {UNCASED})?)|(?P<v_han>[{FAMILIES['han']}][{HAN}]{{0,2}})(?=(?P<t_han>{'|'.join(BEHIND['han'])}))|(?<![{HAN}])(?P<v_kanji>[{HAN}]{{1,4}}?)(?=(?P<t_kanji>{'|'.join(BEHIND['kanji'])}))|(?<![{HANGUL}])(?P<v_hangul>[{FAMILIES['hangul']}][{HANGUL}]{{1,2}}) ?(?=(?P<t_hangul>{'|'.join(BEHIND['hangul'])}))",
}
COMPILED = {k: re.compile(p) for k, p in PATTERNS.items()}
#: A cheap test whether a text can hold any entity of some kinds.
HINTS = {"email": re.compile("@"), "secret": re.compile(r"AKIA|ASIA|[=:]"), "ip": re.compile(r"\d\.\d"), "card": re.compile(r"\d[ -]?\d[ -]?\d"), "phone": re.compile(r"\d{3}"), "national_id": re.compile(r"\d-\d"), "iban": re.compile(r"[A-Z]{2}\d\d"), "ipv6": re.compile(r"::|[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:")}
#: Any title or known given name of scripts with capitals, and any title of the others.
CASED_WHO = re.compile("|".join(map(re.escape, sorted([*TITLES, *(w for w in WHO if w[0].isupper())]))))
UNCASED_WHO = re.compile("|".join(map(re.escape, [*UNCASED_TITLES, *(t for k in BEHIND.values() for t in k)])))
OTHER_SCRIPT = re.compile(r"[\u0370-\u0e7f\u3040-\u30ff\u4e00-\u9fff\uac00-\ud7a3]")

ANY_DIGIT = re.compile(r"\d{2}|\d\.\d")
NEED_DIGITS = {"ip", "card", "phone", "national_id", "iban"}


def luhn(digits: str) -> int:
    """0 for valid numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10


class Surrogates:
    """Keyed permutations. key: secret bytes; whoever has them can invert the replacement of digits and letters."""

    def __init__(self, key: bytes):
        self.key = key
        self.orders: dict[tuple, list[str]] = {}
        self.replace = functools.lru_cache(65_536)(self._replace)

    def prf(self, *parts: object) -> int:
        return int.from_bytes(hmac.new(self.key, "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), hashlib.sha256).digest(), "big")

    def permute(self, x: int, n: int, tweak: str) -> int:
        """A keyed permutation of 0 to n - 1 that is one cycle of all of them, so nothing maps to itself if n > 1.

        It takes x through an unbalanced Feistel network over a * b >= n (repeated until it hits below n), adds a keyed
        step that leaves no shorter cycle, and goes back through the network.
        """
        if n <= 1:
            return x
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        step = self.prf(tweak, n, "step") % n
        while math.gcd(step, n) != 1:
            step = (step + 1) % n
        return self._network((self._network(x, n, a, b, tweak, range(8), 1) + step) % n, n, a, b, tweak, range(7, -1, -1), -1)

    def _network(self, x: int, n: int, a: int, b: int, tweak: str, rounds: range, sign: int) -> int:
        while True:
            left, right = divmod(x, b)
            for r in rounds:
                if r % 2:
                    right = (right + sign * self.prf(tweak, n, r, left)) % b
                else:
                    left = (left + sign * self.prf(tweak, n, r, right)) % a
            x = left * b + right
            if x < n:
                return x

    def string(self, text: str, alphabets: list[str | None], tweak: str, valid: Callable[[str], bool] | None = None) -> str:
        """A permutation of the strings whose characters come from the alphabets (None: fixed) and which are valid, as text is.

        Strings of over 24 free characters are permuted in pieces, each with its place and the fixed characters as tweak.
        """
        free = [i for i, a in enumerate(alphabets) if a]
        out = list(text)
        form = tweak + "/" + "".join("\0" if a else c for a, c in zip(alphabets, text, strict=True))
        if len(form) > LONG_FORM:
            form = tweak + "/" + hashlib.sha256(form.encode("utf-8", "surrogatepass")).hexdigest()
        for at in range(0, len(free), 24):
            part = free[at : at + 24]
            n, x = 1, 0
            for i in part:
                n *= len(alphabets[i])
                x = x * len(alphabets[i]) + alphabets[i].index(text[i])
            sizes = ",".join(str(len(alphabets[i])) for i in part)
            y = self.permute(x, n, f"{form}/{at}/{sizes}")
            self._write(out, part, alphabets, y)
            while valid and not valid("".join(out)):
                y = self.permute(y, n, f"{form}/{at}/{sizes}")
                self._write(out, part, alphabets, y)
        return "".join(out)

    @staticmethod
    def _write(out: list[str], part: list[int], alphabets: list, y: int) -> None:
        for i in reversed(part):
            y, d = divmod(y, len(alphabets[i]))
            out[i] = alphabets[i][d]

    def _replace(self, kind: str, text: str) -> str:
        return getattr(self, f"_{kind}")(text)

    def plain(self, text: str, tweak: str, valid: Callable[[str], bool] | None = None) -> str:
        """Digits to digits and letters to letters of the same case."""
        sets = [DIGITS if "0" <= c <= "9" else LOWER_LETTERS if "a" <= c <= "z" else UPPER_LETTERS if "A" <= c <= "Z" else None for c in text]
        return self.string(text, sets, tweak, valid)

    def _email(self, text: str) -> str:
        local, _, domain = text.partition("@")
        labels = domain.split(".")
        # the reserved example domains and the top level stay; another domain doesn't become one of them
        keep = 2 if len(labels) > 1 and labels[-2].lower() == "example" else 1
        private = ".".join(labels[:-keep])
        if not private:
            return self.plain(local, "email") + "@" + domain
        made = self.plain(f"{local}@{private}", "email", lambda t: keep == 2 or re.split("[.@]", t)[-1].lower() != "example")
        return ".".join([made, *labels[-keep:]])

    @staticmethod
    def secret_kind(text: str) -> str:
        return next((k for k, of in (("hex", HEX_SET), ("HEX", HEX_UP_SET), ("key", UPPER_DIGITS_SET)) if of.issuperset(text)), "plain")

    def _secret(self, text: str) -> str:
        kind = self.secret_kind(text)
        same = lambda t: self.secret_kind(t) == kind
        if kind == "plain":
            return self.plain(text, "secret", same)
        return self.string(text, [{"hex": HEX, "HEX": HEX_UP, "key": UPPER_DIGITS}[kind]] * len(text), kind, same)

    def _card(self, text: str) -> str:
        places = [i for i, c in enumerate(text) if c.isdigit()]
        rest = luhn("".join(text[i] for i in places))
        # all but the first and the last digit are permuted; the last one restores the remainder
        made = self.string(text, [DIGITS if i in places[1:-1] else None for i in range(len(text) - 1)] + [None], f"card{rest}")
        head = "".join(made[i] for i in places[:-1])
        last = next(d for d in DIGITS if luhn(head + d) == rest)
        return made[: places[-1]] + last + made[places[-1] + 1 :]

    def _phone(self, text: str) -> str:
        skip = 0
        if text.startswith("+"):
            # the country code ends at the first separator; an unseparated number keeps its first digit
            skip = m.end() if (m := re.match(r"\+\d{1,3}(?=[ .(-])", text)) else 2
        free = [i for i, c in enumerate(text) if c.isdigit() and i >= skip]
        exchange = lambda t: (m.span() if (m := re.search(r"(?<!\d)555(?!\d)", t[skip:])) else None)
        if kept := exchange(text):
            free = [i for i in free if not skip + kept[0] <= i < skip + kept[1]]
        # the first digit of every group keeps to 0 and 1, or to 2 to 9
        sets = [None if i not in free else DIGITS if text[i - 1 : i].isdigit() else "01" if text[i] in "01" else "23456789" for i in range(len(text))]
        return self.string(text, sets, "phone", lambda t: exchange(t) == kept)

    def _national_id(self, text: str) -> str:
        issued = self._issued(text)
        return self.string(text, [DIGITS if c.isdigit() else None for c in text], f"national_id{issued}", lambda t: self._issued(t) == issued)

    @staticmethod
    def _issued(t: str) -> bool:
        return t[:3] not in ("000", "666") and t[0] != "9" and t[4:6] != "00" and t[7:] != "0000"

    def _ip(self, text: str) -> str:
        octets = [int(o) for o in text.split(".")]
        kind = self.network(octets)
        x = int.from_bytes(bytes(octets), "big")
        low, high = next(((a, b) for a, b, k in RANGES if k == kind), (0, 1 << 32))
        if kind == "loopback":
            return text
        y = low + self.permute(x - low, high - low, f"ip/{kind}")
        while self.network(list(y.to_bytes(4, "big"))) != kind:
            y = low + self.permute(y - low, high - low, f"ip/{kind}")
        return ".".join(map(str, y.to_bytes(4, "big")))

    @staticmethod
    def network(o: list[int]) -> str:
        x = int.from_bytes(bytes(o), "big")
        return next((k for a, b, k in RANGES if a <= x < b), "special" if o[0] in (0, 255) or o[0] >= 224 else "public")

    def _ipv6(self, text: str) -> str:
        groups = [int(g, 16) for g in ipaddress.IPv6Address(text).exploded.split(":")]
        # documentation, link-local, unique local and multicast addresses keep what tells them
        kept = 2 if groups[:2] == [0x2001, 0xDB8] else 1 if groups[0] & 0xFE00 in (0xFC00, 0xFE00) or groups[0] == 0 else 0
        low, high = (0x2000, 0x4000) if groups[0] >> 13 == 1 else (1, 0x10000)
        free = [i for i in range(kept, 8) if groups[i]]
        sizes = {i: (low, high) if i == 0 else (1, 0x10000) for i in free}
        x, n = 0, 1
        for i in free:
            x, n = x * (sizes[i][1] - sizes[i][0]) + groups[i] - sizes[i][0], n * (sizes[i][1] - sizes[i][0])
        form = "/".join(["ipv6", *(f"{g:x}" if i < kept else "*" if g else "0" for i, g in enumerate(groups)), str(low)])
        told = lambda g: g[:2] == [0x2001, 0xDB8] or g[0] & 0xFE00 in (0xFC00, 0xFE00)
        y, made = x, list(groups)
        while True:
            y = z = self.permute(y, n, form)
            for i in reversed(free):
                z, d = divmod(z, sizes[i][1] - sizes[i][0])
                made[i] = d + sizes[i][0]
            if kept or not told(made):
                break
        padded = any(len(g) > 1 and g[0] == "0" for g in text.split(":"))
        out = ipaddress.IPv6Address(sum(g << 112 - 16 * i for i, g in enumerate(made)))
        shown = out.compressed if "::" in text else out.exploded if padded else ":".join(f"{g:x}" for g in made)
        return shown.upper() if re.search("[A-F]", text) else shown

    def _iban(self, text: str) -> str:
        places = [i for i, c in enumerate(text) if c != " "]
        rest = self.mod97("".join(text[i] for i in places))
        free = places[4:]
        sets = [(DIGITS if text[i].isdigit() else UPPER_LETTERS) if i in free else None for i in range(len(text))]
        bare = list(text)
        bare[places[2]] = bare[places[3]] = "0"
        made = list(self.string("".join(bare), sets, f"iban{rest}"))
        # the check digits restore the remainder; 00 to 96 are enough for that
        for k in range(97):
            made[places[2]], made[places[3]] = f"{k:02d}"
            if self.mod97("".join(made[i] for i in places)) == rest:
                break
        return "".join(made)

    @staticmethod
    def mod97(t: str) -> int:
        return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97

    def parts(self, name: str, gender: str, family: bool) -> list[tuple[str, str]]:
        """The parts of a name and their surrogates, separators included. gender: what a title tells; family: a family name
        of FAMILIES stands first, without a space."""
        if family:
            script = "han" if name[0] in FAMILIES["han"] else "hangul"
            return [(name, self.next_of(FAMILIES[script], name[0], "family") + self.word(name[1:]))]
        out, words = [], re.split(r"([ -])", name)
        told = len(words) > 1 and gender and " " in words
        for i, part in enumerate(words):
            if i % 2 or not part:
                out.append((part, part))
            elif i == 0 and part in WHO and (not gender or WHO[part][1] == gender):
                out.append((part, self.given(part)))
            elif i == 0 and told and (script_of(part), gender) in ENDINGS and not part.endswith("."):
                out.append((part, self.word(part, f"given {gender}") + ENDINGS[script_of(part), gender]))
            else:
                out.append((part, self.surname(part)))
        return out

    def next_of(self, members: list[str] | str, one: str, tweak: str) -> str:
        order = self.order(tuple(members), tweak)
        return order[(order.index(one) + 1) % len(order)]

    def order(self, members: tuple[str, ...], tweak: str) -> list[str]:
        if (members, tweak) not in self.orders:
            self.orders[members, tweak] = sorted(members, key=lambda n: self.prf(tweak, n))
        return self.orders[members, tweak]

    def _name(self, text: str) -> str:
        """A single part: the next of its kind."""
        return self.surname(text)

    def given(self, name: str) -> str:
        """The next name on a keyed cycle of the names of its script and gender."""
        return self.next_of(GIVEN[WHO[name]], name, "given")

    def surname(self, name: str) -> str:
        """Another word with the same pattern of letters, never one of the given names."""
        if name in WHO:
            return self.given(name)
        return self.word(name, "surname", lambda t: t not in WHO)

    def word(self, word: str, tweak: str = "word", valid: Callable[[str], bool] | None = None) -> str:
        """Letters to letters of their classes; marks stay."""
        return self.string(word, [CLASS_OF.get(c) for c in word], tweak, valid)


RANGES = [(10 << 24, 11 << 24, "private a"), ((172 << 24) + (16 << 16), (172 << 24) + (32 << 16), "private b"), ((192 << 24) + (168 << 16), (192 << 24) + (169 << 16), "private c"), (127 << 24, 128 << 24, "loopback")]


def may_hold(kind: str, text: str, digits: bool, other: bool) -> bool:
    """A cheap test whether a text can hold an entity of a kind. digits, other: it has some, or letters of other scripts."""
    if kind == "name":
        return CASED_WHO.search(text) is not None
    if kind == "uncased name":
        return other and UNCASED_WHO.search(text) is not None
    return (digits or kind not in NEED_DIGITS) and HINTS[kind].search(text) is not None


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and what is told of it (gender; `+` for a family name that stands first) of the entities of a text, in
    order, without overlaps."""
    found = []
    digits, other = ANY_DIGIT.search(text) is not None, OTHER_SCRIPT.search(text) is not None
    for kind, pattern in COMPILED.items():
        if not may_hold(kind, text, digits, other):
            continue
        for m in pattern.finditer(text):
            group = m.lastgroup if m.lastgroup and m.lastgroup.startswith("v_") else 0
            if kind == "ip" and Surrogates.network([int(o) for o in m[0].split(".")]) == "loopback":
                continue
            if kind == "iban" and Surrogates.mod97(m[0].replace(" ", "")) != 1:
                continue
            if kind == "ipv6" and not is_ipv6(m[0]):
                continue
            found.append(named(m) if "name" in kind else (m.start(group), m.end(group), kind, ""))
    out: list[tuple[int, int, str, str]] = []
    for x in sorted(found, key=lambda x: (x[0], -x[1])):
        if not out or x[0] >= out[-1][1]:
            out.append(x)
    return out


def is_ipv6(text: str) -> bool:
    """An address that isn't a loopback or an unspecified one, nor two words of a program."""
    try:
        found = ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return not found.is_loopback and not found.is_unspecified and (text.count(":") == 7 or "::" in text) and any(c.isdigit() for c in text)


def named(m: re.Match) -> tuple[int, int, str, str]:
    """The entity of a match of the pattern of names."""
    group = next(g for g, value in m.groupdict().items() if value and g.startswith("v_"))
    start, end = m.span(group)
    if group == "v_uncased":  # where no capital tells it, a second word belongs to a known given name alone
        if (first := m[group].split(" ")[0]) not in WHO:
            end = start + len(first)
        return start, end, "name", UNCASED_TITLES[m["before"]]
    script = group[2:]
    if script in BEHIND:
        return start, end, "name", BEHIND[script][m[f"t_{script}"]] + "+" * (script != "kanji")
    return start, end, "name", TITLES[m["title"]] if m["title"] else ""


def name_parts(text: str, found: list[tuple[int, int, str, str]], made: Surrogates) -> dict[str, str]:
    """Surrogates of the parts of the names that were found; of a part that several names have, as in the first of them."""
    out: dict[str, str] = {}
    for start, end, kind, told in found:
        if kind == "name":
            for part, surrogate in made.parts(text[start:end], told.rstrip("+"), "+" in told):
                if part.strip(" -"):
                    out.setdefault(part, surrogate)
    return out


def with_bare_names(text: str, found: list[tuple[int, int, str, str]], parts: dict[str, str]) -> list[tuple[int, int, str, str]]:
    """found and the places outside of it where a part of one of its names stands alone."""
    if not parts:
        return found
    taken = [end for _, end, _, _ in found]
    free = lambda m: not ((k := bisect_right(taken, m.start())) < len(found) and found[k][0] < m.end())
    # words are taken whole and looked up, so that many names cost no more than few
    more = [(m.start(), m.end(), "name", "=") for m in WORDS.finditer(text) if m[0] in parts and not m[0].endswith(".") and free(m)]
    if uncased := sorted((p for p in parts if len(p) > 1 and not p[0].isupper()), key=lambda p: (-len(p), p)):
        more += [(m.start(), m.end(), "name", "=") for m in re.finditer("|".join(map(re.escape, uncased)), text) if free(m)]
    return sorted(found + more)


def substitute(text: str, made: Surrogates) -> tuple[str, list[dict]]:
    pieces, at, listed = [], 0, []
    found = entities(text)
    parts = name_parts(text, found, made)
    back: dict[tuple[str, str], str] = {}
    fixed: dict[tuple[str, str, str], str] = {}
    for start, end, kind, told in with_bare_names(text, found, parts):
        original = text[start:end]
        if (kind, original, told) not in fixed:
            if kind == "name":
                surrogate = parts[original] if told == "=" else "".join(x for _, x in made.parts(original, told.rstrip("+"), "+" in told))
            else:
                surrogate = made.replace(kind, original)
            for _ in range(STEPS):
                if back.setdefault((kind, surrogate), original) == original:
                    break
                surrogate = made.replace(kind, surrogate)
            fixed[kind, original, told] = surrogate
        surrogate = fixed[kind, original, told]
        pieces += [text[at:start], surrogate]
        at = end
        listed.append({"kind": kind, "start": start, "end": end, "surrogate": surrogate})
    return ("".join([*pieces, text[at:]]), listed) if listed else (text, [])


#: Steps along a cycle after which a collision within a text is left for collisions() to tell.
STEPS = 100
ENTITY = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())]))


def surrogates(docs: DataFrame, key: bytes, text: str = "text", listed: bool = True) -> DataFrame:
    """All columns of docs with the texts replaced and, if listed, the entities (spans are those of the original text)."""
    docs = replacing(docs, text, *["entities"] * listed)
    at, schema = docs.columns.index(text), ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Surrogates(key)
        for batch in batches:
            got = [(t, []) if t is None else substitute(t, made) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([g[0] for g in got], batch.schema.field(at).type)
            more = [pa.array([g[1] for g in got], ENTITY)] * listed
            yield pa.RecordBatch.from_arrays([*columns, *more], names=[*batch.schema.names, *["entities"] * listed])

    return map_batches(docs, run, schema + ", entities array<struct<kind:string,start:int,end:int,surrogate:string>>" * listed)


def collisions(found: DataFrame) -> DataFrame:
    """Kinds and surrogates that more than one original has; found has kind, original and surrogate."""
    return found.groupBy("kind", "surrogate", "original").agg(F.lit(1).alias("one")).groupBy("kind", "surrogate").agg(F.count("*").alias("n")).where("n > 1")


#: For the queries alone; production runs pass a key of their own.
DEMO_KEY = b"a key for tests"


def private_documents(docs: DataFrame, key: bytes = DEMO_KEY) -> DataFrame:
    return surrogates(docs.select("doc_id", "text"), key).select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities")
