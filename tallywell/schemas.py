"""Schemas of the experiment model and of its input files."""

from __future__ import annotations

POST = "text string, retweeted_status struct<id: bigint>"

EXPERIMENT = """
  project_name string, output_path string, plate_type string, plate_name string,
  microscope_name string, objective string, timestamp string, cell_line string,
  well_list array<string>, channels_ordered array<string>,
  channels_config array<struct<Name: string, ExposureTime: double, AnalogGain: double, IlluminationIntensity: double>>,
  grid_config struct<
    x: struct<unit: string, N: int, d: double>, y: struct<unit: string, N: int, d: double>,
    z: struct<unit: string, N: int, d: double>, t: struct<unit: string, N: int, d: double>>
"""

COORDINATES = "experiment bigint, well string, site int, x_mm double, y_mm double, z_um double, t timestamp"

COMPOUND_LAYOUT = "well string, compound string, is_reference boolean"

STATUS_EVENT = "experiment bigint, batchid bigint, status string, exit_code int, ts timestamp, seq bigint"

# Relational tables; the natural keys (project, experiment, well, site, batchid) are kept next to the
# generated ones so that loads are set-based joins.
TABLES = {
    "projects": "id bigint, name string",
    "plates": "id bigint, platetypeid bigint, barcode string",
    "experiments": """id bigint, projectid bigint, name string, compound_layout_path string, description string,
        plateid bigint, microscopeid bigint, objectiveid bigint, num_images_x int, num_images_y int,
        num_images_z int, num_images_t int, delta_x_mm double, delta_y_mm double, delta_z_um double,
        delta_t_h double, start_time timestamp_ntz""",
    "plate_types": "id bigint, model_name string, manufacturer string, brand string, num_wells int, other_info string",
    "platetype_wells": "id bigint, platetypeid bigint, well_name string",
    "microscopes": "id bigint, name string",
    "objectives": "id bigint, name string",
    "experiment_wells": "id bigint, experimentid bigint, wellid bigint, cell_line string",
    "experiment_well_sites": """id bigint, experiment_wellid bigint, site_id int, site_x int, site_y int,
        site_z int, site_t int""",
    "experiment_imaging_channels": """id bigint, experimentid bigint, channelid bigint, imaging_order_index int,
        exposure_time_ms double, analog_gain double, illumination_strength double""",
    "imaging_channels": """id bigint, name string, is_fluorescence boolean, fluorescence_wavelength_nm int,
        is_brightfield boolean, brightfield_type string""",
    "images": """id bigint, plateid bigint, s3path string, wellid bigint, site int, site_x int, site_y int,
        site_z int, site_t int, experimentchannelid bigint, coord_x_mm double, coord_y_mm double,
        coord_z_um double, coord_t timestamp""",
    "profile_results": """id bigint, experimentid bigint, batchid bigint, start_time timestamp,
        end_time timestamp, status string""",
    "profile_result_batch_sites": "id bigint, profile_resultid bigint, siteid bigint",
    "profile_result_files": "id bigint, profile_resultid bigint, s3path string, filename string",
}
