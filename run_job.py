"""spark-submit entry point: ``spark-submit --py-files stridelake.zip run_job.py <job> [options]``
(locally: ``python -m stridelake.jobs <job> [options]``)."""

from stridelake.jobs import run

if __name__ == "__main__":
    run()
