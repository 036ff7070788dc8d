import re

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
