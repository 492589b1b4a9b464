"""A site in a folder: ``served.json`` maps URLs to texts, ``broken.json`` lists URLs that fail, ``log`` gets every request."""

import json
from pathlib import Path


class FolderSite:
    def __init__(self, folder):
        self.folder = Path(folder)

    def serve(self, served, broken=()):
        (self.folder / "served.json").write_text(json.dumps(served))
        (self.folder / "broken.json").write_text(json.dumps(list(broken)))
        return self

    def get(self, url):
        with open(self.folder / "log", "a") as log:
            log.write(url + "\n")
        if url in json.loads((self.folder / "broken.json").read_text()):
            raise OSError("refused")
        if (self.folder / "die").exists() and url == (self.folder / "die").read_text():
            import os

            os._exit(9)  # as if the machine were lost
        return json.loads((self.folder / "served.json").read_text()).get(url, "")

    def asked(self):
        log = self.folder / "log"
        out = log.read_text().split() if log.exists() else []
        log.write_text("")
        return out
