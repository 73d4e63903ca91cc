"""What a transport has acknowledged, so that a second attempt sends only the rest.

A transport that delivers each payload for good has no commit that Spark could
undo: a task that dies half way has delivered its first payloads, and its retry,
or the replay of the micro-batch after a restart, would deliver them again. With a
ledger, each task attempt appends one line for every acknowledged payload to a file
of its own; a later attempt of the same work reads the files of the earlier ones
and passes over payloads that are listed with the same content.

Work is named by the streaming query, micro-batch and partition, or, for a batch
job, by the job (its task retries) or the option ``ledger-name`` (running the job
again under the same name goes on where it stopped). Payloads are numbered by
partition; lines must come in the same order again, so batch lines are sorted
inside their tasks. A payload with other content than listed is sent, and counted as
sent again. Between an acknowledgment and its ledger line lies one payload at most:
if the task dies there, that one is delivered twice, under the same name.
"""

from __future__ import annotations

import hashlib
import json

#: Stores whose files can be seen only once they are closed.
_CLOSED_ONLY = ("s3://", "s3a://", "gs://", "gcs://", "abfs://", "abfss://")


def check_folder(path: str) -> None:
    if path.lower().startswith(_CLOSED_ONLY):
        raise ValueError("option 'ledger' needs a folder where flushed lines are seen at once "
                         "(a mounted path or HDFS), not an object store")


def digest(destination: tuple, body: bytes) -> str:
    head = json.dumps(destination).encode()
    return hashlib.blake2b(head + b"\0" + body, digest_size=16).hexdigest()


class Ledger:
    """The acknowledged payloads of one task's work."""

    def __init__(self, path: str, work: str, task: str, attempt: str):
        from tsline.sources.sink import open_folder

        self.fs, root = open_folder(path)
        self.folder = f"{root.rstrip('/')}/{work}"
        self.task, self.attempt = task, attempt
        self.known = self._read()
        self.out = None

    def _read(self) -> dict[int, str]:
        from pyarrow import fs as pafs

        known: dict[int, str] = {}
        for info in self.fs.get_file_info(pafs.FileSelector(self.folder, allow_not_found=True)):
            if not info.base_name.startswith(f"{self.task}-a"):
                continue
            with self.fs.open_input_stream(info.path) as f:
                lines = f.read().split(b"\n")
            for line in lines[:-1]:  # a last line without its end was cut by the failure
                entry = json.loads(line)
                known[entry["seq"]] = entry["digest"]
        return known

    def holds(self, seq: int, content: str) -> bool:
        return self.known.get(seq) == content

    def differs(self, seq: int, content: str) -> bool:
        return seq in self.known and self.known[seq] != content

    def add(self, seq: int, content: str) -> None:
        if self.out is None:
            self.fs.create_dir(self.folder, recursive=True)
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.task}-a{self.attempt}")
        self.out.write(json.dumps({"seq": seq, "digest": content}).encode() + b"\n")
        self.out.flush()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def forget(path: str, works: list[str]) -> None:
    """Drop the ledgers of finished work (on the driver)."""
    from pyarrow import fs as pafs

    from tsline.sources.sink import open_folder

    fs, root = open_folder(path)
    for work in works:
        folder = f"{root.rstrip('/')}/{work}"
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)


def finished_epochs(path: str, query: str, epoch: int) -> list[str]:
    """Ledgers of the micro-batches of a query before ``epoch``: no replay needs them."""
    from pyarrow import fs as pafs

    from tsline.sources.sink import open_folder

    fs, root = open_folder(path)
    done = []
    for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        head, _, number = info.base_name.rpartition("-b")
        if head == query and number.isdigit() and int(number) < epoch:
            done.append(info.base_name)
    return done
