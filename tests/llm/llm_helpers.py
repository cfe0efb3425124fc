"""What several test modules use."""

import re
from pathlib import Path

SF = "/root/testdata/sf0.001"


def word_list(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def sf_exists():
    return Path(SF).exists()
