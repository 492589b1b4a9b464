"""A review client that notes its calls in a file and loses its process once, at a call that is named."""

import os
from collections import Counter
from pathlib import Path

from test_review import GOOD, critique, edit

SPENT = {"requests": 1, "input_tokens": 10, "output_tokens": 1}


class Logged:
    """Each review takes two rounds and an edit: five calls."""

    def __init__(self, folder, die_at=None):
        self.folder, self.die_at = Path(folder), die_at

    def _note(self, source, role):
        with open(self.folder / "calls", "a") as log:
            log.write(f"{source['question_id']} {role}\n")
        if self.die_at == (source["question_id"], role) and not (self.folder / "died").exists():
            (self.folder / "died").touch()
            os._exit(9)  # as if the machine were lost

    async def propose(self, source, previous, feedback):
        self._note(source, "propose2" if feedback else "propose1")
        return GOOD | {"answer_en": "second" if feedback else "first"}, SPENT

    async def critique(self, source, candidate):
        second = candidate["answer_en"] == "second"
        self._note(source, "critique2" if second else "critique1")
        return critique() if second else critique("revise", revision_instructions="again"), SPENT

    async def edit(self, source, candidate):
        self._note(source, "edit")
        return edit(question_en="polished", decision="edited"), SPENT

    def calls(self):
        return Counter((self.folder / "calls").read_text().splitlines())
