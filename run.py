"""Entry for spark-submit; see callmill/jobs.py for the commands."""

from callmill.jobs import main

if __name__ == "__main__":
    result = main()
    if result is not None:
        print(result)
