"""Builds paylake.zip, the package for spark-submit --py-files."""

import zipfile
from pathlib import Path

ROOT = Path(__file__).resolve().parent


def build(target: Path = ROOT / "paylake.zip") -> Path:
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted((ROOT / "paylake").rglob("*.py")):
            out.write(file, file.relative_to(ROOT))
    return target


if __name__ == "__main__":
    print(build())
