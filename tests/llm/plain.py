"""Plain versions of what the operators do, for tests."""

import re
from collections import Counter

import regex

from corpusflow.llm import decontam

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text or "")
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = {p + k for p in range(len(words) - 2) if grams[tuple(words[p : p + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def plain_tokens(text):
    """Template tokens and their values, one to one."""
    t = regex.sub("[\U000f0000-\U000f0003]", "", text or "")
    t = regex.sub(r"([0-9])[.,](?=[0-9])", "\\1" + decontam.POINT, t)
    t = regex.sub(r"(?<=[\p{L}\p{N},;] )(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}])", decontam.NAME + r"\1", t)
    t = regex.sub(r"(?<![\p{L}\p{N}])([0-9][0-9\U000f0003]*)(?![\p{L}\p{N}])", decontam.NUMBER + r"\1", t)
    t = regex.sub("(\U000f0001[0-9\U000f0003]+) ?(" + "|".join(decontam.UNITS.split()) + r")(?![\p{L}\p{N}])", r"\1 " + decontam.UNIT + r"\2", t, flags=regex.I)
    raw = regex.sub(r"[^\p{L}\p{N}\U000f0000-\U000f0003]+", " ", t).strip(" ")
    raw = raw.split(" ") if raw else []
    marks = (decontam.NAME, decontam.NUMBER, decontam.UNIT)
    return [x[0] if x[0] in marks and len(x) > 1 else x.lower() for x in raw], raw


def plain_contaminated(text, items):
    """Whether a text is contaminated by one of ``items``, alignment by alignment."""
    tpl, raw = plain_tokens(text)
    marks = {decontam.NAME, decontam.NUMBER, decontam.UNIT}
    for item in items:
        itpl, iraw = plain_tokens(item)
        if not itpl:
            continue
        w = min(len(itpl), decontam.WINDOW)
        own = [a for a in range(len(itpl) - w + 1) if sum(x not in marks for x in itpl[a : a + w]) >= min(decontam.MIN_WORDS, w)] if len(itpl) >= decontam.MIN_TOKENS else []
        if not own:
            bare = lambda tokens: [regex.sub("[\U000f0000-\U000f0003]", "", x).lower() for x in tokens]
            run, whole = bare(iraw), bare(raw)
            if len(run) >= decontam.MIN_EXACT and any(whole[p : p + len(run)] == run for p in range(len(whole))):
                return True
            continue
        met = {}
        places = {}
        for p in range(len(tpl) - w + 1):
            places.setdefault(tuple(tpl[p : p + w]), []).append(p)
        for a in own:
            for p in places.get(tuple(itpl[a : a + w]), []):
                met.setdefault(p - a, []).append(a)
        covered, longest = set(), 0
        for shift, starts in met.items():
            stands = {}
            for a in starts:
                for k in range(a, a + w):
                    if itpl[k] in marks:
                        stands.setdefault((itpl[k], iraw[k]), set()).add(raw[k + shift])
            sound = []
            for a in starts:
                slots = [k for k in range(a, a + w) if itpl[k] in marks]
                if all(len(stands[itpl[k], iraw[k]]) == 1 for k in slots) or all(iraw[k] == raw[k + shift] for k in slots):
                    sound.append(a)
            covered |= set(sound)
            start, end = None, -1
            for a in sorted(sound):
                start = start if a <= end else a
                end = a + w
                longest = max(longest, end - start)
        if own and (len(covered) >= decontam.MIN_COVER * len(own) or longest >= decontam.MIN_RUN):
            return True
    return False


def jaccard_sets(text, k=5):
    """The word shingles of a text, A-Z lower-cased; of fewer words the whole sequence."""
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())
