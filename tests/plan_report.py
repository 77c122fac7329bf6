"""Print the physical plan outline of selected queries (operators only).

    python tests/plan_report.py [sf_dir] > PLANS.md

Plans of the encryption queries are never printed: the key is a literal in them.
"""
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NAMES = ["person_context", "attach_metadata", "persons_gazetteer", "articles_from_pages", "page_category", "link_counts",
         "crawl_pages", "translate_hits", "translate_misses", "article_counts", "union_sites"]


def outline(tree: str) -> str:
    from newsflow.functions.text import WS_CHARS
    tree = tree.replace(WS_CHARS, "<py-whitespace>").replace(", \n, )", ", <newline>, )")
    tree = re.sub(r"[\x00-\x08\x0b-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]", "?", tree)
    out = []
    for line in tree.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        out.append(line[:150])
    return "\n".join(out)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from __spark_entry__ import queries
    from newsflow.session import build_session
    spark = build_session("local[8]")
    qs = queries()
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], AQE initial plans)\n")
    print("Generated by `python tests/plan_report.py`. Operator trees only; expression details trimmed.\n")
    for n in NAMES:
        df = qs[n](spark, sf_dir)
        tree = df._jdf.queryExecution().executedPlan().treeString()
        scans = re.findall(r"(ReadSchema: [^\n]{0,160}|PushedFilters: \[[^\]]*\])", df._jdf.queryExecution()
                           .executedPlan().toString())
        print(f"## {n}\n\n```\n{outline(tree)}\n```\n")
        for s in dict.fromkeys(scans):
            print(f"- {s}")
        print()


if __name__ == "__main__":
    main(sys.argv)
