"""Fixed wording of official Russian documents, as patterns both Java and Python read: the defaults of F05-F09, F12-F14, F24, T04 and S10.

Phrases are lists of words with any white space between them; other corpora pass their own.
"""

from __future__ import annotations

FLAGS = "(?iuU)"


def phrase(*words: str) -> str:
    return r"\s+".join(words)


PAGE_OPEN, PAGE_CLOSE = "<<<PAGE:", ">>>"
PAGE_MARK = rf"{PAGE_OPEN}(\d+){PAGE_CLOSE}"
#: Stamps and running footers of portals and gazettes.
FOOTERS = (
    r"Страница\s*\d+\s*(?:из\s*\d+)?",
    phrase("документ", "сохранен", "с", "портала"),
    r"docs[.]cntd[.]ru",
    phrase("электронного", "фонда", "из", "более", r"\d+"),
    r"нормативно-[а-я]+" + r"\s+документов",
    phrase("приказ", "министерства", "строительства"),
    phrase("минстрой", "россии"),
    phrase("зарегистрировано", "в", "минюсте"),
    "№" + r"\s*\d+" + "/пр",
    phrase("Собрание", "законодательства"),
    "©" + ".*?" + "CNTD",
    " ".join(["Об утверждении Методики определения стоимости работ", "по подготовке проектной документации", r"[(]с изменениями на", r"\d+", r"\w+", r"\d+", r"года[)]"]),
    " ".join(["и жилищно-коммунального хозяйства", "Российской Федерации от", r"\d+", r"\w+", r"\d+", r"г[.]"]),
    " ".join(["—", r"\d+", r"\d+", "нормативно-правовых", "и"]),
)
#: Characters that a recogniser reads for the first word of a title.
ARTIFACTS, ARTIFACT_WORD = "©[бa]", "Об"
NOTES = r"\s*\([^)]*?(?:" + "|".join(["в редакции", r"изм[.]", r"ред[.]", r"См[.] предыдущую"]) + r").*?\)\s*"
STAMPS = "|".join([phrase("сведения", "сформированы", "фгис", "цс"), r"fgiscs[.]minstroyrf[.]ru"])
TABLE, CLAUSE, INTRODUCTION, WHOLE = "Таблица", "Пункт", "Введение", "Общий текст"
ALPHABET = "".join(map(chr, range(ord("а"), ord("я") + 1)))
QUESTION, ANSWER, SOURCES, DOCUMENT, ABSENT = "Вопрос", "Ответ", "Источники", "Документ", "Не указано"
CUT = "\n...[обрезано]"
PART = r"\s*(?:част[ьи]\s*\d+)\s*$"
#: White space after the end of a sentence, unless an initial or a two-letter abbreviation ends there. The dot in the
#: look-behinds stands for any character, so that an end after an ordinary word of three letters or more is none.
SENTENCE_GAP = r"(?<!\w.\w.)(?<![A-Z][a-z].)(?<=[.?!])\s"
NO_DATA = f"{ANSWER}: нет данных в контексте: база не нашла подходящие фрагменты. Уточните запрос."
FAILED = f"{ANSWER}: ошибка генерации ответа."
