from pyspark.sql import functions as F

from chorale.session import LISTING_TASKS


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    """A folder per batch: with Spark's default a listing has nearly a task for each."""
    rows = spark.range(200).select((F.col("id")).alias("batch"), F.col("id").cast("string").alias("video_id"))
    rows.coalesce(1).write.partitionBy("batch").json(str(tmp_path / "batches"))
    context = spark.sparkContext
    context.setJobGroup("listing-test", "folders")
    back = spark.read.schema("video_id string, batch string").json(str(tmp_path / "batches"))
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing-test") for s in tracker.getJobInfo(j).stageIds]
    assert tasks and max(tasks) <= LISTING_TASKS
    assert back.count() == 200
