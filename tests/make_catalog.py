"""Rewrite freightlens/catalog.py from the query(...) registrations in the sources."""

import pathlib
import re
import textwrap

root = pathlib.Path(__file__).resolve().parent.parent
out = ['"""Which module registers which query."""', "", "CATALOG = {"]
for path in sorted(root.glob("freightlens/*/*.py")):
    found = re.findall(r"""query\(\s*"(\w+)"\s*\)""", path.read_text())
    if found:
        module = ".".join(path.relative_to(root).with_suffix("").parts)
        out.append(f'    "{module}": """')
        out += textwrap.wrap(" ".join(found), 100, initial_indent="        ", subsequent_indent="        ")
        out.append('    """,')
out.append("}")
(root / "freightlens/catalog.py").write_text("\n".join(out) + "\n")
