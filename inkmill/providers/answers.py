"""Answers that are kept across tasks and runs, so that no call is paid for twice."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, MutableMapping
from urllib.parse import unquote, urlsplit

from pyarrow import fs


class AnswerFolder(MutableMapping):
    """Answers by key as files of a folder that all executors reach; keys are file names.

    A file appears whole or not at all, since it is written under another name first.
    """

    def __init__(self, location: str):
        if location.startswith("file:"):
            self.files, self.path = fs.LocalFileSystem(), unquote(urlsplit(location).path)
        elif "://" in location:
            self.files, self.path = fs.FileSystem.from_uri(location)
        else:
            self.files, self.path = fs.LocalFileSystem(), location
        self.files.create_dir(self.path)

    def _at(self, key: str) -> str:
        return f"{self.path}/{key}.answer"

    def __getitem__(self, key: str) -> str:
        try:
            with self.files.open_input_stream(self._at(key)) as f:
                return f.read().decode()
        except FileNotFoundError:
            raise KeyError(key) from None

    def __setitem__(self, key: str, answer: str) -> None:
        new = f"{self.path}/{uuid.uuid4().hex}.new"
        with self.files.open_output_stream(new) as f:
            f.write(answer.encode())
        self.files.move(new, self._at(key))

    def __delitem__(self, key: str) -> None:
        self.files.delete_file(self._at(key))

    def __iter__(self) -> Iterator[str]:
        for info in self.files.get_file_info(fs.FileSelector(self.path)):
            if info.base_name.endswith(".answer"):
                yield info.base_name.removesuffix(".answer")

    def __len__(self) -> int:
        return sum(1 for _ in self)
