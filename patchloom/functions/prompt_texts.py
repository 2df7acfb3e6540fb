"""The prompt wordings. They must match byte for byte to be comparable."""

# --- repair prompt -----------------------------------------------------------------
REPAIR_HEAD = "You are a software engineer fixing a bug in the repository `"
REPAIR_PROBLEM = "`.\n\n## Problem Description\n"
REPAIR_HINTS = "\n## Hints\n"
REPAIR_TAIL = """
## Instructions
Analyze the bug and provide a fix as a unified diff patch. Your response must include
a code block with the patch in unified diff format that can be applied with `git apply`.

```diff
--- a/path/to/file.py
+++ b/path/to/file.py
@@ ... @@
 context line
-old line
+new line
 context line
```
"""

# --- generated problem statement ------------------------------------------------------
STATEMENT_HEAD = "There is a bug in "
STATEMENT_TESTS = " that causes the following test(s) to fail:\n"
STATEMENT_TAIL = "\n\nPlease investigate the failing tests and fix the underlying issue."
UNKNOWN_FILES = "unknown files"
UNKNOWN_TESTS = "- (unknown tests)"

# --- bug-writing prompts ---------------------------------------------------------------
BUG_EXAMPLES = [
    "Alter calculation order for incorrect results: Rearrange the sequence of operations in a calculation to subtly change the output (e.g., change (a + b) * c to a + (b * c)).",
    "Introduce subtle data transformation errors: Modify data processing logic, such as flipping a sign, truncating a value, or applying the wrong transformation function.",
    "Change variable assignments to alter computation state: Assign a wrong or outdated value to a variable that affects subsequent logic.",
    "Mishandle edge cases for specific inputs: Change handling logic to ignore or improperly handle boundary cases, like an empty array or a null input.",
    "Modify logic in conditionals or loops: Adjust conditions or loop boundaries (e.g., replace <= with <) to change the control flow.",
    "Introduce off-by-one errors in indices or loop boundaries: Shift an index or iteration boundary by one, such as starting a loop at 1 instead of 0.",
    "Adjust default values or constants to affect behavior: Change a hardcoded value or default parameter that alters how the function behaves under normal use.",
    "Reorder operations while maintaining syntax: Rearrange steps in a process so the function produces incorrect intermediate results without breaking the code.",
    "Swallow exceptions or return defaults silently: Introduce logic that catches an error but doesn't log or handle it properly, leading to silent failures.",
]
TIPS = [
    "It should not cause compilation errors.",
    "It should not be a syntax error.",
    "It should be subtle and challenging to detect.",
    "It should not modify the function signature.",
    "It should not modify the documentation significantly.",
    "For longer functions, if there is an opportunity to introduce multiple bugs, please do!",
    "Please DO NOT INCLUDE COMMENTS IN THE CODE indicating the bug location or the bug itself.",
]
EXAMPLES_SHOWN = 3

ANSWER_FORMAT = """Your answer should be formatted as follows:

Explanation:
<explanation>

Bugged Code:
```
<bugged_code>
```"""

MODIFY_HEAD = """You are a software developer doing chaos monkey testing.
Your job is to rewrite a function such that it introduces a logical bug that will break existing unit test(s) in a codebase.

To this end, some kinds of bugs you might introduce include:
"""
MODIFY_TIPS = "\n\nTips about the bug-introducing task:\n"
MODIFY_TAIL = "\n\n" + ANSWER_FORMAT

FUNCTION_INSTANCE = """<INPUT>
{src_code}
</INPUT>

<IMPORTANT>As a reminder, Please DO NOT INCLUDE ANY COMMENTS IN THE CODE OR POINT OUT THE BUG IN ANY WAY.</IMPORTANT>

OUTPUT:"""

CLASS_SYSTEM = (
    """You are a software developer doing chaos monkey testing.
Your job is to rewrite a class such that it introduces logical bugs that will break existing tests.

To this end, some kinds of bugs you might introduce include:
"""
    + "\n".join("- " + example for example in BUG_EXAMPLES)
    + """

Your rewritten class...
- SHOULD NOT cause compilation errors.
- SHOULD NOT have obvious syntax errors.
- SHOULD NOT modify any function signatures or class names.
- SHOULD NOT modify the documentation significantly.
- SHOULD NOT include comments indicating the bug location or the bug itself.

The bugs in your rewritten code should:
- Be subtle and challenging to detect.
- If you can introduce bugs that involve multiple functions or classes, please do!
- A simple way to introduce bugs is to remove code blocks without introducing syntax errors such as undefined variables."""
)
CLASS_INSTANCE = """INPUT:
{src_code}

--------------
As a reminder, Please DO NOT INCLUDE COMMENTS IN THE CODE THAT REVEAL THE LOCATIONS OR SOLUTIONS OF BUGS
--------------

OUTPUT:"""

TIRED_SYSTEM = (
    """You are a simulation of a tired, deadline-pressured developer who has just worked 14 consecutive hours.

Your task was to improve the provided code.
Despite your best intentions, your exhausted state causes you to introduce subtle, real-world bugs that would pass code review but cause issues in production.

Rewrite a function such that it introduces a logical bug that will subtly break existing unit tests in a codebase.

Here's how to proceed:

1. First understand what the code is trying to achieve
2. Consider how a well-intentioned but fatigued developer might misunderstand it
3. Implement changes based on that flawed understanding
4. Ensure the bug represents a genuine cognitive error, not a contrived modification
5. The code should look like a good-faith attempt at solving the problem
6. The bug should be something that could genuinely ship to production

Tips about the bug-introducing task:

"""
    + "\n".join("- " + tip for tip in TIPS)
    + """
- Your code must be included in triple backticks.

"""
    + ANSWER_FORMAT
)

REWRITE_SYSTEM = """You are a software developer and you have been asked to implement a function.

You will be given the contents of an entire file, with one or more functions defined in it.
Please implement the function(s) that are missing.
Do NOT modify the function signature, including the function name, parameters, return types, or docstring if provided.
Do NOT change any other code in the file.
You should not use any external libraries."""
REWRITE_INSTANCE = """Please implement the function `{func_signature}` in the following code:

```
{file_src_code}
```

Remember, you should not modify the function signature, including the function name, parameters, return types, or docstring if provided.
Do NOT change any other code in the file.
Format your output as:

<explanation>

```
{func_to_write}
```"""
