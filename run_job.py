"""spark-submit launcher for salesflow jobs.

    spark-submit --py-files salesflow.zip run_job.py <job> [options]     (see salesflow/jobs.py)
"""

from salesflow.jobs import run

if __name__ == "__main__":
    run()
